"""Token counts: rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens; the distinct new ones of a batch lie end to end in one
numpy array of symbols. In every round each sequence looks up the ranks of its adjacent
pairs, takes its lowest, and applies that merge at all its places at once; sequences
without a pair are done, and the surviving symbols are counted. Counts of pre-tokens are
kept in a table of at most ``CACHE`` entries a task.

Results equal the tokenizers library's for a byte-level BPE file, without added special
tokens; a special token's string inside a text counts as one token, as is its default.
Null and empty texts have 0 bytes and 0 tokens; repeated rows repeat; an empty table gives
an empty result. Extra columns are left out.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm.common import map_text, table

# Fixed value: the pre-token pattern of byte-level BPE, with white space as Unicode has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
CACHE, LIMIT = 800_000, 512


def byte_letters() -> list[str]:
    """The printable letter that byte-level files write for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@dataclass
class Ranks:
    """Merge table: sorted pair keys, their ranks, and the symbol that each rank makes."""

    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    first: np.ndarray  # symbol of each byte
    size: int
    special: tuple

    @classmethod
    def load(cls, path: str) -> Ranks:
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        vocab = j["model"]["vocab"]
        size = max(vocab.values()) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in j["model"]["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        first = np.array([vocab.get(c, -1) for c in byte_letters()], np.int64)
        return cls(keys[order], order.astype(np.int64), made, first, size, tuple(x["content"] for x in j.get("added_tokens", []) if x["special"]))

    def look_up(self, pair: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], len(self.made))


def merge_counts(pieces: Sequence[bytes], r: Ranks) -> np.ndarray:
    """Number of symbols that survive in each piece."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    out = np.zeros(len(pieces), np.int64)
    sym = r.first[np.frombuffer(b"".join(pieces), np.uint8)]
    seq = np.repeat(np.arange(len(pieces)), lengths)
    none = len(r.made)
    while len(sym):
        pair = np.full(len(sym), none, np.int64)
        inside = np.flatnonzero(seq[1:] == seq[:-1])
        pair[inside] = r.look_up(sym[inside] * r.size + sym[inside + 1])
        start = np.r_[0, np.flatnonzero(seq[1:] != seq[:-1]) + 1]
        n = np.diff(np.r_[start, len(seq)])
        low = np.minimum.reduceat(pair, start)
        done = low == none
        out[seq[start[done]]] = n[done]
        low = np.repeat(low, n)
        at = np.flatnonzero((pair == low) & (low < none))
        if not len(at):
            break
        # Of touching places (the same symbol again and again) every second one merges, from the left.
        head = np.r_[True, np.diff(at) != 1]
        run = np.repeat(at[head], np.diff(np.r_[np.flatnonzero(head), len(at)]))
        at = at[(at - run) % 2 == 0]
        sym[at] = r.made[pair[at]]
        keep = low < none
        keep[at + 1] = False
        sym, seq = sym[keep], seq[keep]
    return out


def counter(r: Ranks):
    pattern = regex.compile(PATTERN)
    splitter = regex.compile("|".join(map(regex.escape, r.special))) if r.special else None
    known: dict[str, int] = {}

    def f(texts: pa.Array) -> list:
        tokens, extra = [], []
        for t in texts.to_pylist():
            parts = splitter.split(t) if splitter and "<|" in t else [t]
            extra.append(len(parts) - 1)
            tokens.append(pattern.findall(t) if len(parts) == 1 else [x for p in parts for x in pattern.findall(p)])
        if len(known) > CACHE:
            known.clear()
        new = [x for x in set().union(*tokens) if x not in known]
        for i in range(0, len(new), 100_000):
            part = new[i : i + 100_000]
            known.update(zip(part, merge_counts([x.encode() for x in part], r).tolist(), strict=True))
        n = [sum(map(known.__getitem__, x)) + e for x, e in zip(tokens, extra, strict=True)]
        return [pc.cast(pc.binary_length(texts), pa.int64()), n]

    return f


def count(df: DataFrame, path: str, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keep``, ``n_bytes`` and ``n_tokens`` of every row's whole text. The merge table is broadcast; its size is the file's."""
    shared = df.sparkSession.sparkContext.broadcast(Ranks.load(path))
    return map_text(df, lambda: counter(shared.value), keep, "n_bytes bigint, n_tokens bigint", text_col)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"]).withColumn("over_limit", F.col("n_tokens") > LIMIT)
