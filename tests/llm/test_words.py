import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import ALNUM, LOWER, WORD
from quotelake.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z\n\t\x0b9-é日 ", max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_of_many_texts_are_those_of_each(texts, limit):
    column = pa.array(texts, pa.string())
    seen = 0
    for run in W.runs(column, limit):
        assert run.first == seen
        seen += run.count
        for kind, fold, pattern in ((W.SPACED, None, WORD), (W.ALNUM, W.LOWER, ALNUM)):
            found = W.words_of(run, kind, fold)
            for i in range(run.count):
                own = slice(found.bounds[i], found.bounds[i + 1])
                body = (texts[run.first + i] or "").encode()
                got = [run.data[a:b].tobytes() for a, b in zip(found.start[own], found.end[own])]
                if fold is not None:
                    body, got = body.translate(LOWER), [word.translate(LOWER) for word in got]
                assert got == pattern.findall(body)
                for word, h in zip(got, found.hash[own]):
                    alone = next(W.runs(pa.array([word.decode()])))
                    assert W.words_of(alone, kind, fold).hash[0] == h
    assert seen == len(texts)


def test_grams_depend_on_their_words_alone():
    run = next(W.runs(pa.array(["a b c d", "x b c d y", "b c", "bc d"])))
    words = W.words_of(run)
    grams, valid = W.gram_hashes(words, 3), W.gram_valid(words, 3)
    assert valid.tolist() == [True, True, False, False, True, True, True, False, False, False, False, False, False]
    assert grams[1] == grams[5] and grams[0] != grams[4]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.integers(1, 9))
def test_sliding_argmin_takes_the_last_smallest(values, width):
    values = np.array(values, np.uint64)
    expected = [max(range(i, i + width), key=lambda p: (-int(values[p]), p))
                for i in range(len(values) - width + 1)]
    assert W.sliding_argmin(values, width).tolist() == expected
