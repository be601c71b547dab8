"""Helpers of the tests."""

import re

import numpy as np
from hypothesis import strategies as st

from estimand.llm import tokens

sizes = st.lists(st.integers(1, 20), min_size=1, max_size=60)


def ids_of(text):
    """Ids of a text and the end id, by the tokenizer itself."""
    ids = tokens.encoder().model.encode(text or "", add_special_tokens=False).ids
    return np.append(np.asarray(ids, "<u4"), np.uint32(0)).astype("<u4")


def words_of(text, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)
