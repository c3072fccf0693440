import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from retailloom.llm import language, tokens
from retailloom.llm.queries import tokenizer_path
from retailloom.llm.text import PLAIN_WORDS, SPACED_WORDS, Words, ranges, shingles, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9é \n.-ß", max_size=40)), max_size=8)


def found_words(texts, classes):
    out = []
    for _, _, data, at in slices(pa.array(texts, pa.string()), 16):
        words = Words(data, at, classes)
        for row in range(len(at) - 1):
            low = words.first[row]
            out.append([words.folded[words.begin[low + i] : words.end[low + i]].tobytes().decode() for i in range(words.count[row])])
    return out


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    assert found_words(texts, PLAIN_WORDS) == [brute.words(t) for t in texts]
    assert found_words(texts, SPACED_WORDS) == [(t or "").split() for t in texts]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_equal_shingles_have_equal_hashes_and_others_do_not(texts):
    known = {}
    for first, end, data, at in slices(pa.array(texts, pa.string())):
        row, value = shingles(Words(data, at, PLAIN_WORDS), 3)
        for r in range(end - first):
            own = brute.words(texts[first + r])
            expected = [tuple(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
            assert len(expected) == (row == r).sum()
            for shingle, code in zip(expected, value[row == r].tolist(), strict=True):
                assert known.setdefault(shingle, code) == code
    assert len(set(known.values())) == len(known)


def test_ranges_lists_every_index():
    owner, index = ranges(np.array([0, 5, 3]), np.array([2, 5, 6]))
    assert owner.tolist() == [0, 0, 2, 2, 2] and index.tolist() == [0, 1, 3, 4, 5]


def test_a_batch_is_one_run_and_each_text_ends_in_its_place():
    line = "Of the words of a line, some are new: "
    texts = ["", None, line, "", "", " \n ", line * 120_000, "<|x|> Last.", "", None]
    encoder = tokens.ChunkEncoder(tokenizer_path())
    runs = list(encoder.encode(pa.array(texts), 1))
    assert [(first, last) for first, last, *_ in runs] == [(0, len(texts))]
    own = lambda t: [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    ends = np.cumsum(runs[0][3])
    found = [runs[0][2][a:b].tolist() for a, b in zip(ends - runs[0][3], ends, strict=True)]
    assert found[:6] + found[7:] == [own(t) for t in texts[:6] + texts[7:]]
    assert found[6] == own(line)[:-1] * 120_000 + [1]
    for some in (["", None], [None], ["a"]):
        _, _, flat, sizes = next(encoder.encode(pa.array(some, pa.string()), 1))
        assert flat.tolist() == [i for t in some for i in own(t)] and sizes.sum() == len(flat)


def test_a_language_sample_is_packed_on_its_way_to_the_driver():
    texts = [f"Text {i} of a sample, with words that come again and again; " * 40 for i in range(8)]
    out = list(language._sample_counts([pa.record_batch([pa.array(texts), pa.array(["en"] * 8)], ["text", "lang"])]))
    for text, batch in zip(texts, out, strict=True):
        sparse = language._unpacked(batch.column(0)[0].as_py())
        whole = pa.array(language._pieces(text.encode()), pa.binary())
        counts = np.concatenate([c for _, _, c in language.blocks(whole)])
        assert (language._dense(sparse) == counts).all()
        assert batch.nbytes < sum(len(c) + len(s) for c, s in sparse) / 2
