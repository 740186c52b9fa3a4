"""Encoding texts inside tasks with a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabprep.llm import scan


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the rest follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: How byte-level encoding cuts a text before merging: a fixed value of the format.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids of texts as the tokenizer file gives them, without special tokens added.

    A plain byte-level vocabulary whose ids follow its merge order is encoded by ranks, which gives
    the same ids several times faster. Texts that spell an added token, and all other kinds of
    tokenizer, go to the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        self._ranks = self._by_ranks(spec)

    def _by_ranks(self, spec: dict):
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and spec.get("normalizer") is None and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        plain = plain and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        plain = plain and (spec.get("post_processor") is None or spec["post_processor"].get("type") == "ByteLevel")
        if not plain:
            return None
        joined = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ids = [model["vocab"].get(m.replace(" ", "")) for m in joined]
        if None in ids or ids != sorted(ids) or len(set(ids)) != len(ids):
            return None
        import tiktoken

        byte_of = _byte_of()
        skip = set(self.added)
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in skip}
        return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    @property
    def exact(self):
        if not hasattr(self, "_exact"):
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.path)
        return self._exact

    def ids(self, text: str) -> list[int]:
        if self._ranks is None or any(x in text for x in self.added):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self._ranks.encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _lengths(path: str, ending: int):
    schema = pa.schema([("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for rows, _, _ in scan.slices(batches, "text"):
            counts = [len(encode(t or "")) + ending for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(counts, np.int64))], schema=schema)

    return run


def encoded_lengths(docs: DataFrame, tokenizer: str, ending: int = 1) -> DataFrame:
    """``n_tokens`` of every row's ``text`` (null: empty), with ``ending`` tokens after each."""
    return docs.select(docs.text.cast("string").alias("text")).mapInArrow(_lengths(tokenizer, ending), "n_tokens long")
