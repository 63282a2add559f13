"""Word batches of slices, nulls and empty texts."""

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from nivalis.llm import common

text = st.one_of(st.none(), st.text(alphabet=st.one_of(st.sampled_from("Ab1 \t\n\x0b\x0c\r.-É "), st.characters(codec="utf-8")), max_size=20))
LOWER = {c: c + 32 for c in range(65, 91)}


@settings(max_examples=200, deadline=None)
@given(st.lists(text, max_size=8), st.integers(0, 4), st.integers(0, 4), st.integers(1, 30))
def test_words_of_sliced_batches(texts, skip, cut, most):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())}).slice(skip, max(0, len(texts) - skip - cut))
    want = [t or "" for t in texts[skip : skip + batch.num_rows]]
    for split, pattern in ((common.split_words, r"[^\x20\x09-\x0D]+"), (common.split_alnum, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got = []
        for part in common.slices(batch, most=most):
            words, offsets = split(common.plain_text(part))
            words = words.to_pylist()
            got += [words[a:b] for a, b in zip(offsets, offsets[1:])]
        assert got == [re.findall(pattern, t.translate(LOWER)) for t in want]
