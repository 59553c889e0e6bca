"""What the word tokenizer keeps is bounded, and does not change ids."""

import numpy as np

from runlens.llm import packing
from runlens.llm.queries import tokenizer_file


def test_ids_do_not_depend_on_what_is_kept():
    texts = [" ".join(f"w{i * 7 % 31}x don't Ünï{i % 13}co." for i in range(200)), "<|endoftext|> a\tb\xa0c", "", "é\x85ß"]
    small, large = (packing.WordTokenizer(tokenizer_file(), keep=n) for n in (5, 400_000))
    for text in texts:
        want = large.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(small.ids(text), "<u4").tolist() == np.frombuffer(large.ids(text), "<u4").tolist() == want
    assert len(small.parts) <= 5 and len(small.runs) <= 5 < len(large.parts)
