"""BPE encoding and decoding: a backtracking encoder.

An Aho-Corasick automaton over the vocabulary finds, in one pass over a word, the longest
token that starts at each place. The encoder walks left to right with those tokens; a
token may follow another only if the pair is compatible, that is, if merging the two
tokens' bytes gives back the same two tokens. Where it isn't, the encoder tries the next
shorter token that starts there, or goes back one; places from which there is no way on
are marked, so each is left at most once for each token length and the time is linear.
The result is exactly that of the merges in rank order. Compatibility comes from the
merge tree: the symbols at the border of the two tokens, with the ranks at which each is
made and used up, and whether a pair of them would merge before that. Answers are kept.

Decoding slices a table of all token strings, end to end, by their offsets.

Results equal the tokenizers library's for word_bpe_49k.json (normal form C, lower case,
words with an end mark), special tokens inside texts included. Where the library's tables
of characters are older than Python's, the library's count: it is asked once, on the
driver, which characters it classes, lower-cases or reorders otherwise. Null and empty texts have
no token and decode to the empty text; repeated rows repeat; an empty table gives an empty
result. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Sequence
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex, normalizers, pre_tokenizers

from snapquarry.llm.common import map_text, table
from snapquarry.llm.tokencount import byte_letters

# Fixed value: the words of the file's pre-tokenizer, white space as Unicode has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
CACHE, END = 300_000, 0x2000
NEVER = 1 << 40


class Exceptions:
    """Characters that the tokenizer library sees otherwise than Python: ``apart`` (never reordered or composed there, with their lower case) and ``kind`` (with a character of the class they have there). ``any`` holds both."""

    def __init__(self, block: int = 1 << 12) -> None:
        classes = [(c, pre_tokenizers.Split(Regex(theirs), behavior="removed", invert=True), regex.compile(ours)) for c, theirs, ours in (("x", r"\p{L}", r"\p{L}"), ("0", r"\p{N}", r"\p{N}"), (" ", r"\s", r"\p{White_Space}"))]
        normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.kind, self.apart, mapped = {}, {}, set()
        for start in range(0x80, 0x110000, block):  # a block at a time, so that the driver needs little memory
            known = regex.findall(r"[^\p{Cn}\p{Co}\p{Cs}]", "".join(map(chr, range(start, min(start + block, 0x110000)))))
            for stand_in, theirs, ours in classes:
                found = {w for w, _ in theirs.pre_tokenize_str("".join(known))}
                mine = set(ours.findall("".join(known)))
                self.kind |= dict.fromkeys(mine - found, "!") | dict.fromkeys(found - mine, stand_in)
            lower = normal.normalize_str("\n".join(known)).split("\n") if known else []
            odd = {c for c, t in zip(known, lower, strict=True) if t != plain_form(c)}
            for around in ("%s\u0334", "\u0345%s") if known else ():  # marks of a low and a high combining class
                tried = [around % c for c in known]
                odd |= {c for c, t, u in zip(known, normal.normalize_str("\n".join(tried)).split("\n"), map(plain_form, tried), strict=True) if t != u}
            self.apart |= {c: t for c, t in zip(known, lower, strict=True) if c in odd}
            mapped |= {(c, t) for c, t in zip(known, lower, strict=True) if t != c}
        self.any = frozenset(self.apart) | frozenset(self.kind) | {c for c, t in mapped if not self.kind.keys().isdisjoint(t)}


def plain_form(text: str) -> str:
    """Normal form C in lower case, by Python's tables; a sigma is the same everywhere in a word."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Vocabulary:
    """What the encoder and the decoder need of a tokenizer file; plain data, small enough to broadcast (the file's size)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        self.exceptions = Exceptions()
        self.suffix = j["model"].get("end_of_word_suffix") or ""
        vocab = j["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in j["model"]["merges"]]
        self.special = {x["content"]: x["id"] for x in j.get("added_tokens", []) if x["special"]}
        n = len(self.suffix)
        self.parts, self.rank, self.made_at = {}, {}, {}
        for k, (a, b) in enumerate(merges):
            whole = vocab[a + b[:-n] + self.suffix if n and b.endswith(self.suffix) else a + b]
            self.rank[vocab[a], vocab[b]] = k
            self.parts[whole], self.made_at[whole] = (vocab[a], vocab[b]), k
        byte = {c: b for b, c in enumerate(byte_letters())}
        end = {c: chr(END + b) for c, b in byte.items()}
        self.words = {}  # token string over the encoder's alphabet -> id
        for t, i in vocab.items():
            if n and t.endswith(self.suffix) and len(t) > n:
                self.words[t[: -n - 1] + end[t[-n - 1]]] = i
            else:
                self.words[t] = i
        self.words = {t: i for t, i in self.words.items() if self.reachable(t, i)}
        strings = {**vocab, **self.special}
        size = max(strings.values()) + 1
        names = [b""] * size
        for t, i in strings.items():
            names[i] = t.encode() + b" "
        self.blob = np.frombuffer(b"".join(names), np.uint8)
        self.offsets = np.r_[0, np.cumsum([len(x) for x in names])].astype(np.int64)

    def reachable(self, t: str, i: int) -> bool:
        """The token's own merge tree consists of known parts only, down to single symbols."""
        if len(t) == 1:
            return True
        return i in self.parts and all(p in self.parts or self.single(p) for p in self.parts[i])

    def single(self, i: int) -> bool:
        return i not in self.parts


class Encoder:
    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.auto = ahocorasick.Automaton()
        for t, i in v.words.items():
            self.auto.add_word(t, (i, len(t)))
        self.auto.make_automaton()
        self.length = {i: len(t) for t, i in v.words.items()}
        self.text = {i: t for t, i in v.words.items()}
        self.pairs: dict[int, bool] = {}
        self.prefix: dict[int, int] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.letters, self.ends = byte_letters(), [chr(END + b) for b in range(256)]
        self.pattern = regex.compile(PATTERN)
        self.kind = str.maketrans(v.exceptions.kind)
        self.apart = v.exceptions.apart
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, v.special)) + ")") if v.special else None

    def border(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Symbols at a token's right (1) or left (0) border: (symbol, made at, used up at)."""
        out, until = [], NEVER
        while True:
            made = self.v.made_at.get(token, -1)
            out.append((token, made, until))
            if made < 0:
                return out
            token, until = self.v.parts[token][side], made

    def compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        ok = self.pairs.get(key)
        if ok is None:
            ok, rank = True, self.v.rank
            for x, x_made, x_used in self.border(a, 1):
                for y, y_made, y_used in self.border(b, 0):
                    # The left neighbour wins a tie, as merges of one rank go from the left.
                    if x_made < y_used and y_made < x_used and (r := rank.get((x, y))) is not None and r < x_used and r <= y_used:
                        ok = False
                        break
                if not ok:
                    break
            self.pairs[key] = ok
        return ok

    def shorter(self, token: int) -> int:
        """The longest other token that the token starts with, or -1."""
        got = self.prefix.get(token)
        if got is None:
            t = self.text[token]
            got = next((self.v.words[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.v.words), -1)
            self.prefix[token] = got
        return got

    def encode_symbols(self, w: str) -> tuple[int, ...]:
        n = len(w)
        longest = [-1] * (n + 1)
        reach = [0] * n
        for end, (i, size) in self.auto.iter(w):
            at = end - size + 1
            if size > reach[at]:
                reach[at], longest[at] = size, i
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        length = self.length
        while at < n:
            end = at + length[token]
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at, token = end, longest[end]
                continue
            token = self.shorter(token)
            while token < 0:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = self.shorter(token)
        return tuple(out)

    def encode_word(self, word: str) -> tuple[int, ...]:
        b = word.encode()
        if not self.v.suffix:
            return self.encode_symbols("".join(self.letters[x] for x in b))
        return self.encode_symbols("".join(self.letters[x] for x in b[:-1]) + self.ends[b[-1]])

    def odd_words(self, text: str) -> list[str]:
        """The words of a text with exceptions: pieces between those that stay apart take their normal form alone, and classes are read off stand-ins."""
        out: list[str] = []
        at = 0
        for i, c in enumerate(text):
            if c in self.apart:
                out += plain_form(text[at:i]), self.apart[c]
                at = i + 1
        text = "".join(out) + plain_form(text[at:])
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.kind))]

    def encode_plain(self, text: str) -> list[tuple[int, ...]]:
        if text.isascii():
            words = self.pattern.findall(text.lower())
        elif self.v.exceptions.any.isdisjoint(text):
            words = self.pattern.findall(plain_form(text))
        else:
            words = self.odd_words(text)
        known = self.known
        try:
            return [known[w] for w in words]
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            if len(self.pairs) > 2 * CACHE:
                self.pairs.clear()
            for w in words:
                if w not in known:
                    known[w] = self.encode_word(w)
            return [known[w] for w in words]

    def encode(self, text: str) -> list[int]:
        if self.splitter is None or "<|" not in text:
            return list(chain.from_iterable(self.encode_plain(text)))
        out: list[int] = []
        for part in self.splitter.split(text):
            if part in self.v.special:
                out.append(self.v.special[part])
            else:
                out += chain.from_iterable(self.encode_plain(part))
        return out


def decode(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The tokens' strings, one space between them."""
    if not len(ids):
        return b""
    start, n = v.offsets[ids], v.offsets[ids + 1] - v.offsets[ids]
    total = np.cumsum(n)
    at = np.arange(total[-1]) + np.repeat(start - (total - n), n)
    return v.blob[at[:-1]].tobytes()


def encode_texts(df: DataFrame, path: str, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keep``, ``n_tokens``, ``ids`` and ``decoded`` of every row's whole text."""
    return _apply(df, path, keep, text_col, "n_tokens bigint, ids array<int>, decoded string", lambda ids, names, back: (ids, back.decode()))


def digests(df: DataFrame, path: str, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """As ``encode_texts``, with SHA-256 digests in place of ids and decoded text."""

    def last(ids: list, names: list, back: bytes) -> tuple[str, str]:
        return hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(back).hexdigest()

    return _apply(df, path, keep, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", last)


def _apply(df: DataFrame, path: str, keep: Sequence[str], text_col: str, fields: str, last) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def make():
        v = shared.value
        encoder, names = Encoder(v), [str(i) for i in range(len(v.offsets) - 1)]

        def f(texts: pa.Array) -> list:
            n, left, right = [], [], []
            for t in texts.to_pylist():
                ids = encoder.encode(t)
                a, b = last(ids, names, decode(v, np.array(ids, np.int64)))
                n.append(len(ids))
                left.append(a)
                right.append(b)
            return [n, left, right]

        return f

    return map_text(df, make, keep, fields, text_col)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
