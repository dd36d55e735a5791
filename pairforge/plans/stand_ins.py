"""Deterministic stand-ins for the model hooks, used by the contract queries and
tests.  They behave like the real services at the interface: the generator
echoes the prompt in front of each completion (as a completion server does);
the scorer maps a text to a
reward.  Both are expressible in SQL, so the hook plumbing can be checked."""

from __future__ import annotations

import hashlib

import pandas as pd


def echo_generator(prompts: list[str], k: int, model: str = "", tag: str = "", **_: object) -> list[list[str]]:
    """``model``: what a loader returned; it shows in the texts."""
    return [[f"{p}{model}{tag}response {i} of {len(p)}" for i in range(k)] for p in prompts]


def md5_scorer(texts: pd.Series) -> pd.Series:
    """reward = (first 4 hex digits of md5(text) mod 41) / 8 - 2.5."""
    return texts.map(lambda t: (int(hashlib.md5(t.encode("utf-8")).hexdigest()[:4], 16) % 41) / 8 - 2.5)


def trigram_tokeniser(texts: list[str]) -> list[list[int]]:
    """Pieces of three characters, white space included; a piece's id is the first 24 bits of its MD5."""
    piece_id = lambda p: int(hashlib.md5(p.encode("utf-8")).hexdigest()[:6], 16)
    known: dict[str, int] = {}
    out = []
    for t in texts:
        pieces = [t[i:i + 3] for i in range(0, len(t), 3)]
        known |= {p: piece_id(p) for p in set(pieces) - known.keys()}
        out.append([known[p] for p in pieces])
    return out


def make_md5_predict():
    """``predict_batch_udf`` factory for the same scorer (numpy array in, numpy array out)."""
    import numpy as np

    def predict(texts: "np.ndarray") -> "np.ndarray":
        return md5_scorer(pd.Series(texts)).to_numpy(dtype="float64")

    return predict
