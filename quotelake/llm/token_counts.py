"""Token counts that follow edits.

A document's pre-tokens are gathered in leaves of ``LEAF`` (edits may fill one up to
``MOST``); a segment tree over the leaves
keeps the characters and tokens below every node. An edit finds its first leaf by the
characters before it, cuts pre-tokens anew from there, and stops at the first leaf border
behind the edit where old and new pre-tokens end together: from a common border on they are
the same, since a pre-token depends on nothing before its start, and on two characters
behind its end at most. Only that region is encoded again; sums change on the paths above
its leaves. While edits are applied the text is held as the texts of its leaves, so that an edit
costs what it touches, not the text. Trees are a column, so they may be stored beside the
texts and edited later.

Edits (start, stop, text) are applied in order, with places in characters of the text as the
edits before left it, and are clipped to it.

Defined results: null and empty texts have no tokens; a null list of edits is an empty one;
null places count as the start, a null replacement as empty; strings of special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.store import prepared

LEAF = 32
MOST = 16 * LEAF
SEEN_BEHIND = 2             # characters that a pre-token's end may depend on
CACHE = 1 << 18
EDITS = "array<struct<start:int,stop:int,text:string>>"
TREE = "struct<chars:array<int>,tokens:array<int>>"


class Counter:
    """Tokens of pre-tokens, remembered up to a bound."""

    def __init__(self, lines: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        self.encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def tokens(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[piece] = len(self.encoding.encode_ordinary(piece))
        return found


class Tree:
    """Segment tree over leaves of pre-tokens; node 1 is the root, leaves start at ``width``."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> Tree:
        width = 1 << max(0, (len(chars) - 1).bit_length())
        both = []
        for values in (chars, tokens):
            nodes = np.zeros(2 * width, np.int32)
            nodes[width:width + len(values)] = values
            at = width
            while at > 1:
                at //= 2
                nodes[at:2 * at] = nodes[2 * at:4 * at:2] + nodes[2 * at + 1:4 * at:2]
            both.append(nodes)
        return cls(*both)

    @classmethod
    def of_text(cls, text: str, counter: Counter) -> Tree:
        return cls.of_leaves(*_leaves(counter.pattern.findall(text), counter))

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before the leaf."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            left = int(self.chars[node])
            if place >= before + left:
                before += left
                node += 1
        return node - self.width, before

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.width + leaf
        for nodes, value in ((self.chars, chars), (self.tokens, tokens)):
            change, at = value - int(nodes[node]), node
            while at:
                nodes[at] += change
                at //= 2


def _leaves(pieces: list[str], counter: Counter, size: int = LEAF) -> tuple[list[int], list[int]]:
    known, tokens = counter.known, counter.tokens
    chars, sums = [], []
    for at in range(0, len(pieces), size):
        part = pieces[at:at + size]
        chars.append(sum(map(len, part)))
        sums.append(sum(known.get(p) or tokens(p) for p in part))
    return chars or [0], sums or [0]


class Draft:
    """A text under edit, as the texts of its tree's leaves."""

    def __init__(self, text: str, tree: Tree, counter: Counter):
        self.tree, self.counter = tree, counter
        ends = np.cumsum(tree.chars[tree.width:], dtype=np.int64).tolist()
        self.parts = [text[a:b] for a, b in zip([0, *ends], ends)]

    def text(self) -> str:
        return "".join(self.parts)

    def edit(self, start: int, stop: int, new: str) -> int:
        """Puts ``new`` in place of the characters from start to stop and returns how many
        characters were encoded again."""
        tree, parts, last = self.tree, self.parts, self.tree.width
        size = int(tree.chars[1])
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        shift = len(new) - (stop - start)
        first, before = tree.leaf_at(max(0, min(start - SEEN_BEHIND, size - 1)))
        ahead, end = first, before
        while end < stop or ahead == first:
            end += len(parts[ahead])
            ahead += 1
        window = "".join(parts[first:ahead])
        window = window[:start - before] + new + window[stop - before:]
        pieces: list[str] = []
        leaf, border, at, more, open_ = first, before, before, 1, True
        while open_:
            window += "".join(parts[ahead:ahead + more])
            ahead, more = min(last, ahead + more), 2 * more
            for match in self.counter.pattern.finditer(window, at - before):
                if ahead < last and match.end() + SEEN_BEHIND > len(window):
                    break       # what follows may change this one
                pieces.append(match.group())
                at = before + match.end()
                while leaf < last and border < max(stop, at - shift):
                    border += len(parts[leaf])
                    leaf += 1
                if border >= stop and at - shift == border:
                    open_ = False
                    break
            else:
                if ahead == last:
                    leaf, open_ = last, False
        self._replace(first, leaf, pieces)
        return at - before

    def _replace(self, first: int, leaf: int, pieces: list[str]) -> None:
        """Puts pieces in place of the leaves from first to leaf."""
        tree, parts, room = self.tree, self.parts, leaf - first
        fits = room > 0 and len(pieces) <= MOST * room
        size = max(LEAF, -(-len(pieces) // room)) if fits else LEAF
        chars, tokens = _leaves(pieces, self.counter, size)
        texts = ["".join(pieces[i:i + size]) for i in range(0, len(pieces), size)] or [""]
        if fits:
            for i in range(room):
                c, t, text = (chars[i], tokens[i], texts[i]) if i < len(chars) else (0, 0, "")
                parts[first + i] = text
                node = tree.width + first + i
                if tree.chars[node] != c or tree.tokens[node] != t:
                    tree.put(first + i, c, t)
            return
        # More than the leaves may hold: the tree is laid out anew from leaf sums.
        rows = list(zip(tree.chars[tree.width:].tolist(), tree.tokens[tree.width:].tolist(), parts))
        rows = [r for r in rows[:first] if r[0]] + list(zip(chars, tokens, texts)) + [r for r in rows[leaf:] if r[0]]
        self.tree = Tree.of_leaves([r[0] for r in rows], [r[1] for r in rows])
        self.parts = [r[2] for r in rows] + [""] * (self.tree.width - len(rows))


def edit(text: str, tree: Tree, start: int, stop: int, new: str, counter: Counter) -> tuple[str, Tree, int]:
    """The edited text, its tree, and how many characters were encoded again."""
    draft = Draft(text, tree, counter)
    again = draft.edit(start, stop, new)
    return draft.text(), draft.tree, again


_made: dict[str, Counter] = {}


class _Shared:
    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            self._lines = spark.sparkContext.broadcast(file.read())
        self._pattern, self._key = pattern, uuid.uuid4().hex

    def counter(self) -> Counter:
        """The counter of this Python worker."""
        if self._key not in _made:
            _made.clear()
            _made[self._key] = Counter(self._lines.value, self._pattern)
        return _made[self._key]


def _arrow_trees(trees: list[Tree]) -> pa.StructArray:
    lists = [pa.array([getattr(t, name) for t in trees], pa.list_(pa.int32())) for name in ("chars", "tokens")]
    return pa.StructArray.from_arrays(lists, ["chars", "tokens"])


def _grow(shared, names):
    def batch_grow(batches):
        counter = shared.counter()
        for batch in batches:
            trees = [Tree.of_text(text or "", counter) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, _arrow_trees(trees)], names=names)

    return batch_grow


def _apply(shared, names):
    def batch_apply(batches):
        counter = shared.counter()
        for batch in batches:
            texts, trees, counted = [], [], []
            held = batch.column(1)
            chars, tokens = held.field("chars"), held.field("tokens")
            for i, (text, edits) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                tree = Tree(*(np.array(x[i].values, np.int32) for x in (chars, tokens)))
                again, new = 0, text or ""
                if edits:
                    draft = Draft(new, tree, counter)
                    again = sum(draft.edit(e["start"] or 0, e["stop"] or 0, e["text"] or "") for e in edits)
                    new, tree = draft.text(), draft.tree
                texts.append(text if text is None and not new else new)
                trees.append(tree)
                counted.append(again)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), _arrow_trees(trees), *batch.columns[3:],
                 pa.array(counted, pa.int64())], names=names)

    return batch_apply


def with_trees(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
               tree_col: str = "tree") -> DataFrame:
    """Adds the tree of each text; an input column of that name is replaced."""
    shared = _Shared(prepared(docs.sparkSession), ranks_path, pattern)
    rest = [c for c in docs.columns if c not in (text_col, tree_col)]
    inner = docs.select(F.col(f"`{text_col}`").alias("x"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    names = [*inner.columns, "tree"]
    out = inner.mapInArrow(_grow(shared, names), inner.select("*", F.lit(None).cast(TREE).alias("tree")).schema)
    return out.select(*[F.col("x").alias(c) if c == text_col else F.col(f"c{rest.index(c)}").alias(c)
                        for c in docs.columns if c != tree_col], F.col("tree").alias(tree_col))


def edited(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", tree_col: str = "tree",
           edits_col: str = "edits") -> DataFrame:
    """Applies the edits of each row to its text and tree, and adds ``encoded_chars``, the
    characters that were encoded again. The column of edits is dropped."""
    shared = _Shared(prepared(docs.sparkSession), ranks_path, pattern)
    rest = [c for c in docs.columns if c not in (text_col, tree_col, edits_col, "encoded_chars")]
    inner = docs.select(F.col(f"`{text_col}`").alias("x"), F.col(f"`{tree_col}`").alias("tree"),
                        F.col(f"`{edits_col}`").cast(EDITS).alias("edits"),
                        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    outer = inner.drop("edits").withColumn("again", F.lit(0).cast("long"))
    out = inner.mapInArrow(_apply(shared, outer.columns), outer.schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("x").alias(text_col),
                      F.col("tree").alias(tree_col), F.col("again").alias("encoded_chars"))


def n_tokens(tree_col: str = "tree"):
    """Tokens of a text by its tree."""
    return F.get(F.col(f"{tree_col}.tokens"), F.lit(1)).cast("long")


# Personal data and keys that a corpus must not keep: mail and network addresses, long
# numbers, and quoted keys.
REDACTIONS = regex.compile(
    r"(?P<mail>[\w.+-]++@[\w-]++(?:\.[\w-]++)+)|(?P<address>\b\d{1,3}(?:\.\d{1,3}){3}\b)"
    r"|(?P<number>\b\d{9,}\b)|(?P<key>\"[0-9a-fA-F]{32,}\")")


def _redact(names):
    def batch_redact(batches):
        for batch in batches:
            lists = []
            for text in batch.column(0).to_pylist():
                found, shift = [], 0
                for match in REDACTIONS.finditer(text or ""):
                    new = f"<{match.lastgroup}>"
                    found.append({"start": match.start() + shift, "stop": match.end() + shift, "text": new})
                    shift += len(new) - (match.end() - match.start())
                lists.append(found)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, kind)], names=names)

    return batch_redact


def with_redactions(docs: DataFrame, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """Adds edits that put a name in place of personal data and keys."""
    prepared(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (text_col, edits_col)]
    inner = docs.select(F.col(f"`{text_col}`").alias("x"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    names = [*inner.columns, "edits"]
    out = inner.mapInArrow(_redact(names), inner.select("*", F.lit(None).cast(EDITS).alias("edits")).schema)
    return out.select(*[F.col("x").alias(c) if c == text_col else F.col(f"c{rest.index(c)}").alias(c)
                        for c in docs.columns if c != edits_col], F.col("edits").alias(edits_col))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its tokens before and after personal data is masked in it."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    grown = with_redactions(with_trees(docs, path, pattern)).select(
        "doc_id", "text", "tree", "edits", n_tokens().alias("tokens_before"),
        F.size("edits").cast("long").alias("n_edits"))
    return edited(grown, path, pattern).select(
        "doc_id", "tokens_before", "n_edits", n_tokens().alias("tokens_after"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars_after"), "encoded_chars")
