"""Secret scans: assignment-aware lexing.

The lexer reads whole texts as source or configuration syntax and finds name-literal pairs:

- assignments, also with a type between (``name = "..."``, ``name := ...``, ``name: str = "..."``)
- keys of objects and indented blocks (``"name": "..."``, ``name: value``, ``"name" => "..."``),
  block scalars, list items ``name: NAME`` / ``value: ...``, subscripts (``env["NAME"] = "..."``),
  elements (``<name>...</name>``) and arguments (``f(name="...")``, ``set_name("...")``,
  ``put("NAME", "...")``)
- right sides that join literals and names (``+``, ``.``, neighbouring strings) or wrap a
  literal in a decoding call

Strings may be triple-quoted or hold escapes. A name on the right side stands for the
constant of that name in the nearest enclosing scope (braces, or indented definitions); an
unknown name is no literal. A bare word is one only where it can't be a name: it starts
with a digit or has characters or digits that names don't.

Each literal gets a score: how sensitive the target's name is (parts such as password,
secret, token, key, auth; less where its last part says what is kept about the secret; a
key inside a container of secrets takes the container's weight) times how random the
literal looks (length, character classes, entropy, blanks). Literals that reach
``THRESHOLD`` are spans of kind ``pair``, at the literal where it is written.

The three base kinds (assign, access, hex) are fixed patterns; the method adds spans and
never takes one away. Spans are kind:start:end in code points, the end exclusive, sorted
by start, then by kind in the order assign, access, hex, pair.

Defined results: null and empty texts have no span; repeated rows repeat; an empty table
gives an empty result; names, literals and joins may have any length. Extra columns are
left out unless kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from snapquarry.llm.common import map_text, table

# The base kinds' patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 or more characters in all
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "pair")

# Weights of the parts of a target's name, and parts that say something else about it.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pass": 0.9, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "privatekey": 1.0, "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "key": 0.6, "access": 0.4, "client": 0.2, "private": 0.5, "signing": 0.5, "salt": 0.5}
CONTAINERS = {"passwords": 1.0, "secrets": 1.0, "tokens": 0.9, "credentials": 0.9, "apikeys": 1.0, "keys": 0.6}
PASS_WORDS = frozenset(("password", "passwd", "pass", "pwd", "passphrase"))
ABOUT = frozenset("name id type length size count url uri path file dir field column label format algorithm expires expiry ttl timeout header prefix policy hint index map table cache sort row".split())
OPEN_KEYS = frozenset("public primary foreign partition lookup composite unique natural surrogate".split())
GENERIC = frozenset("value data default literal raw text string current prod dev main key".split())
WRAPPERS = frozenset("decode encode bytes str string fromhex unhexlify atob b64decode base64 secretstr secret password".split())
NAMING, SETTING = frozenset(("name", "key")), frozenset(("set", "with", "use"))
DEFINITIONS = frozenset("def class func function fn".split())
THRESHOLD, LEAST = 0.5, 6

WORTH = re.compile("|".join(sorted(SENSITIVE)), re.IGNORECASE)
QUOTED = r'''"""(?:[^"\\]|\\.|"(?!""))*+"""|\'\'\'(?:[^'\\]|\\.|'(?!''))*+\'\'\'|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`]*+`'''
STRING = re.compile(rf"[rRbBfFuU]{{0,2}}(?P<s>{QUOTED})", re.DOTALL)
NAME_TEXT = r"[A-Za-z_$][A-Za-z0-9_$]*+(?:(?:\.|->|::|-)[A-Za-z_$][A-Za-z0-9_$]*+)*+"
NAME = re.compile(NAME_TEXT)
TOKEN = re.compile(
    rf"""(?P<line>\n(?P<indent>[\x20\t]*+)(?:-[\x20\t]+)?(?=[^\s]))|(?P<brace>[{{}}])|<(?P<element>[A-Za-z_][A-Za-z0-9_.:-]*+)>(?P<body>[^<>]*+)</(?P=element)>"""
    rf"""|(?<![A-Za-z0-9_\\])(?:[rRbBfFuU]{{1,2}})?(?P<string>{QUOTED})|(?<![A-Za-z0-9_$.])(?P<name>{NAME_TEXT})(?P<next>[\x20\t]*+(?::=|=>|=(?!=)|:(?![:/=])|\())|(?<![A-Za-z0-9_$.])(?P<definition>def|class|func|function|fn)(?=[\x20\t])""",
    re.DOTALL | re.ASCII,
)
AFTER_STRING = re.compile(r"[\x20\t]*+(?P<op>\][\x20\t]*+=(?!=)|=>|:(?![:/=])|=(?!=))")
TYPED = re.compile(r"""[\x20\t]*+[A-Za-z_*&][A-Za-z0-9_.<>\[\]|?*&\x20\t]*+=(?!=)""")
TWO = re.compile(rf"\s*+(?P<a>{QUOTED})\s*+,\s*+(?P<b>{QUOTED})\s*+(?=[,)])", re.DOTALL)
ONE = re.compile(rf"\s*+(?P<a>{QUOTED})\s*+(?=\))", re.DOTALL)
SCALAR = re.compile(r"[\x20\t]*+[|>][+-]?[\x20\t]*+\n")
BLANK = re.compile(r"[\x20\t]*+(?:\([\x20\t]*+\n?[\x20\t]*+|\\\n[\x20\t]*+)?")
END = re.compile(r"[\x20\t]*+(?:#[^\n]*+)?(?:\n|\Z)")
JOIN = re.compile(r"(?:[\x20\t]*+(?:\\?\n[\x20\t]*+)?(?:\+|\.\.?|\|\|)\s*+(?=[\"'`A-Za-z_]))")
BESIDE = re.compile(r"[\x20\t]*+(?:\\?\n[\x20\t]*+)?(?=[rRbBfFuU]{0,2}[\"'])")
BARE = re.compile(r"[A-Za-z0-9+/_.=~-]+", re.ASCII)
ALIKE = re.compile(r"[A-Za-z]*[0-9]*(?:[_.-][A-Za-z]*[0-9]*)*")  # what may be a name: digits only at the end of a part
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
BREAK = re.compile(r"\n[\x20\t]*+")
ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def parts_of(name: str) -> list[str]:
    return [x.lower() for x in PARTS.findall(name)]


def sensitivity(name: str, container: str = "") -> float:
    """0 to 1: the heaviest of a name's parts and pairs of parts."""
    parts = parts_of(name)
    both = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    found = sorted((SENSITIVE.get(x, CONTAINERS.get(x, 0.0)) for x in parts + both), reverse=True)
    weight = min(1.0, found[0] + 0.5 * found[1]) if len(found) > 1 else (found[0] if found else 0.0)
    if parts and parts[-1] in ABOUT or OPEN_KEYS.intersection(parts):
        weight *= 0.3
    if container:
        last = parts_of(container)[-1:]
        if last and last[0] in CONTAINERS:
            weight = max(weight, CONTAINERS[last[0]] if not parts or parts[-1] not in ABOUT else 0.0)
        elif all(p in GENERIC for p in parts):
            weight = max(weight, 0.9 * sensitivity(container))
    return weight


def randomness(literal: str | Counter[str], passphrase: bool = False) -> float:
    """0 to 1: entropy per character, length and mix of character classes; blanks speak against all but passphrases."""
    count = Counter(literal)
    n = count.total()
    if n < LEAST:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in count.values())
    have = "".join(count)
    classes = bool(re.search("[a-z]", have)) + bool(re.search("[A-Z]", have)) + bool(re.search("[0-9]", have)) + bool(re.search("[^A-Za-z0-9]", have))
    blanks = sum(c for x, c in count.items() if x.isspace())
    return min(1.0, entropy / 3.2) * min(1.0, 0.4 + min(n, 20) / 20) * (0.45, 0.85, 1.0, 1.0)[max(0, classes - 1)] * ((0.6 if passphrase else 0.3) if blanks * 20 > n else 1.0)


class Value:
    """What a name stands for: literals (text, start, end) and earlier values, joined.

    Values refer to each other and aren't copied out, so constants that are doubled over
    and over stay small; of the joined text only its characters' counts are needed.
    """

    __slots__ = ("count", "found", "parts")

    def __init__(self, parts: list) -> None:
        self.parts, self.count, self.found = parts, None, False

    def characters(self) -> Counter[str]:
        todo = [self]
        while todo:
            now = todo[-1]
            open_ = [] if now.count is not None else [p for p in now.parts if isinstance(p, Value) and p.count is None]
            if open_:
                todo += open_
                continue
            todo.pop()
            if now.count is None:
                now.count = Counter()
                for p in now.parts:
                    now.count.update(p.count if isinstance(p, Value) else p[0])
        return self.count

    def places(self) -> list[tuple[int, int]]:
        """Of all literals that aren't empty and weren't given before."""
        out, todo = [], [self]
        while todo:
            now = todo.pop()
            if now.found:
                continue
            now.found = True
            for p in now.parts:
                if isinstance(p, Value):
                    todo.append(p)
                elif p[0]:
                    out.append(p[1:])
        return out


class Scope:
    """Constants of a block, its name, and where it ends: at its brace, or at the first line that is indented no deeper."""

    __slots__ = ("brace", "constants", "indent", "name", "naming")

    def __init__(self, name: str = "", brace: bool = False, indent: int = -1) -> None:
        self.name, self.brace, self.indent, self.naming = name, brace, indent, ""
        self.constants: set[str] = set()


class Lexer:
    def __init__(self, text: str) -> None:
        self.text, self.indent, self.found = text, len(text) - len(text.lstrip(" \t")), set()
        self.scopes, self.braces = [Scope()], 0
        self.known: dict[str, list[Value]] = {}  # a name's values, that of the innermost scope last
        self.pending = ""  # the key before an opening brace

    def constant(self, name: str) -> Value | None:
        for key in (name, re.split(r"\.|->|::", name)[-1]):
            if self.known.get(key):
                return self.known[key][-1]
        return None

    def keep(self, name: str, value: Value) -> None:
        scope, values = self.scopes[-1], self.known.setdefault(name, [])
        if name in scope.constants:
            values.pop()
        scope.constants.add(name)
        values.append(value)

    def leave(self) -> None:
        scope = self.scopes.pop()
        self.braces -= scope.brace
        for name in scope.constants:
            self.known[name].pop()

    def quoted(self, m: re.Match, group: str) -> tuple[str, int, int]:
        """(content without escapes and line breaks, start, end) of a string."""
        whole, at = m[group], m.start(group)
        k = 3 if whole[:3] in ('"""', "'''") else 1
        inside = BREAK.sub("", whole[k:-k])
        return ESCAPE.sub(r"\1", inside) if "\\" in inside else inside, at + k, m.end(group) - k

    def value(self, at: int) -> tuple[list, int]:
        """The literals and constants joined on a right side, and its end."""
        text, parts = self.text, []
        while True:
            if m := STRING.match(text, at):
                parts.append(self.quoted(m, "s"))
                at = m.end()
                if beside := BESIDE.match(text, at):
                    at = beside.end()
                    continue
            elif (m := BARE.match(text, at)) and text[m.end() : m.end() + 1] != "(" and self.constant(m[0]) is None and not ALIKE.fullmatch(m[0].rstrip(".")):
                literal = m[0].rstrip(".")
                parts.append((literal, at, at + len(literal)))
                at = m.end()
            elif m := NAME.match(text, at):
                at = m.end()
                if text[at : at + 1] == "(":
                    inner = ONE.match(text, at + 1)
                    if inner and WRAPPERS.intersection([*parts_of(m[0]), m[0].lower().rsplit(".", 1)[-1]]):
                        parts.append(self.quoted(inner, "a"))
                        at = inner.end() + 1
                    else:
                        return parts, at
                elif (known := self.constant(m[0])) is not None:
                    parts.append(known)
            else:
                return parts, at
            join = JOIN.match(text, at)
            if not join:
                return parts, at
            at = join.end()

    def pair(self, name: str, parts: list) -> None:
        if not parts:
            return
        scope, words, value = self.scopes[-1], parts_of(name), Value(parts)
        self.keep(name, value)
        if words[-1:] == ["value"] and scope.naming:
            name, scope.naming = scope.naming, ""
        elif words and words[-1] in NAMING and len(parts) == 1 and not isinstance(parts[0], Value):
            scope.naming = parts[0][0]
        weight = sensitivity(name, scope.name)
        if weight >= THRESHOLD and weight * randomness(value.characters(), bool(PASS_WORDS.intersection(parts_of(name)))) >= THRESHOLD:
            self.found.update(value.places())

    def assigned(self, name: str, op: str, at: int) -> int:
        """Read the right side of ``name op``; the place to go on from."""
        text = self.text
        if op[-1:] == ":":
            if typed := TYPED.match(text, at):
                at = typed.end()
            elif scalar := SCALAR.match(text, at):
                at = stop = scalar.end()
                while line := re.compile(r"[\x20\t]*+(?:\n|(?=(?P<rest>[^\n])))").match(text, stop):
                    if line["rest"] is not None and line.end() - stop <= self.indent or line.end() == len(text) == stop:
                        break
                    stop = (text.find("\n", line.end()) + 1 or len(text)) if line["rest"] is not None else line.end()
                body = text[at:stop]
                start = at + len(body) - len(body.lstrip())
                if body.strip():
                    self.pair(name, [(BREAK.sub("", body.strip()), start, start + len(body.strip()))])
                return stop - 1 if stop > at and text[stop - 1] == "\n" else stop
            elif END.match(text, at):
                self.scopes.append(Scope(name, indent=self.indent))
                return at
        at = BLANK.match(text, at).end()
        if text[at : at + 1] == "{":
            self.pending = name
            return at
        parts, end = self.value(at)
        self.pair(name, parts)
        if not parts and parts_of(name)[-1:] in (["name"], ["key"]) and (named := NAME.match(text, at)):
            self.scopes[-1].naming = named[0]
        return max(at, end)

    def read(self) -> list[tuple[int, int]]:
        text, at, plain = self.text, 0, NAME
        while m := TOKEN.search(text, at):
            at = m.end()
            if m["line"] is not None:
                self.indent = len(m["indent"]) + (m["line"].rstrip(" \t").endswith("-") and 2)
                while len(self.scopes) > 1 and not self.scopes[-1].brace and self.scopes[-1].indent >= self.indent:
                    self.leave()
                if m["line"].rstrip(" \t").endswith("-"):
                    self.scopes[-1].naming = ""
            elif m["brace"] == "{":
                self.scopes.append(Scope(self.pending, brace=True))
                self.pending = ""
                self.braces += 1
            elif m["brace"]:
                braces = self.braces
                while self.braces == braces and braces:
                    self.leave()
            elif m["element"]:
                body = m["body"].strip()
                start = m.start("body") + len(m["body"]) - len(m["body"].lstrip())
                self.pair(m["element"], [(body, start, start + len(body))] if body else [])
            elif m["string"]:
                content, _, _ = self.quoted(m, "string")
                after = AFTER_STRING.match(text, at)
                if after and plain.fullmatch(content):
                    at = self.assigned(content, after["op"], after.end())
            elif m["definition"]:
                self.scopes.append(Scope(indent=self.indent))
            elif m["next"][-1] == "(":
                two, one = TWO.match(text, at), ONE.match(text, at)
                if two and plain.fullmatch(name := self.quoted(two, "a")[0]):
                    self.pair(name, [self.quoted(two, "b")])
                elif one and parts_of(m["name"].rsplit(".", 1)[-1])[:1] and parts_of(m["name"].rsplit(".", 1)[-1])[0] in SETTING:
                    self.pair(m["name"].rsplit(".", 1)[-1], [self.quoted(one, "a")])
            else:
                at = self.assigned(m["name"], m["next"].strip(), at)
        return sorted(self.found)


def pairs(text: str) -> list[tuple[int, int]]:
    """Places of the literals that score high enough for their target's name. Every form has one of four characters and a part of a sensitive name; texts without aren't lexed."""
    return Lexer(text).read() if any(c in text for c in ":=(<") and WORTH.search(text) else []


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's index, end) of every span, sorted."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out + [(s, 3, e) for s, e in pairs(text)])


def written(found: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def redacted(text: str, found: Sequence[tuple[int, int, int]], mark: str = "<secret>") -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    out, at = [], 0
    merged: list[list[int]] = []
    for s, _, e in found:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def scan(df: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keep``; counts of the base kinds and of pairs; all spans; the base spans; the text with its spans replaced."""

    def f(texts: pa.Array) -> list:
        counts, every, base, clean = [[], [], [], []], [], [], []
        for t in texts.to_pylist():
            found = spans(t)
            for k in range(4):
                counts[k].append(sum(x[1] == k for x in found))
            every.append(written(found))
            base.append(written([x for x in found if x[1] < 3]))
            clean.append(redacted(t, found) if found else t)
        return [*counts, every, base, clean]

    return map_text(df, lambda: f, keep, "n_assign bigint, n_access bigint, n_hex bigint, n_pair bigint, spans string, base_spans string, redacted string", text_col)


def digests(df: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """As ``scan`` without the texts, and the SHA-256 of the base spans."""

    def f(texts: pa.Array) -> list:
        found = [spans(t) for t in texts.to_pylist()]
        base = [written([x for x in s if x[1] < 3]) for s in found]
        return [*([sum(x[1] == k for x in s) for s in found] for k in range(4)), [hashlib.sha256(b.encode()).hexdigest() for b in base], [written(s) for s in found]]

    return map_text(df, lambda: f, keep, "n_assign bigint, n_access bigint, n_hex bigint, n_pair bigint, base_sha256 string, spans string", text_col)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_pair")
