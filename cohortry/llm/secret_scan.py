"""Secrets in texts: fixed patterns, and assignment-aware lexing of source and configuration syntax.

The lexer cuts a text into strings (single, double, back-quoted and tripled), words, operators, brackets and line ends. A parser reads
``name = value``, ``name: value``, ``"name": value``, ``name => value``, ``name: type = value``, ``map["name"] = value``, values in calls
and parentheses, on the next line, in lists, and under an enclosing name (``"password": {"value": ...}``), into pairs of
names and expressions of literals, bare words and earlier names, joined by ``+`` or side by side. Names that are
assigned literals become constants, so ``A = "..."`` and ``password = A`` give the literal's place; a later assignment of a name takes the place of an earlier. A
literal is reported when its name is sensitive and the literal looks like a key: 8 to ``KEY_BYTES`` bytes, of ``KEY_PARTS`` joined parts at most. Parts of a larger value are judged
each on its own, and it is no constant. Time is in proportion to the text's length, also for quotes and brackets that nothing closes.

Defined results: a null or empty text has no spans; rows with equal ids are scanned each on its own; very long texts are scanned whole; other
columns, whatever their names, are kept by ``redact`` and play no part.
Spans count code points, the end is exclusive. A literal inside a span of a pattern isn't reported twice.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the contract, on UTF-8 bytes.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
KINDS = ("assign", "access", "hex", "literal")
SENSITIVE = frozenset("password passwd pwd passphrase secret secrets token credential credentials apikey authkey privatekey accesskey secretkey".split())
SENSITIVE_PAIRS = frozenset({("api", "key"), ("auth", "key"), ("private", "key"), ("access", "key"), ("signing", "key"), ("encryption", "key"), ("account", "key"), ("db", "pass"), ("user", "pass"), ("auth", "bearer")})
LITERAL_HINTS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"key", b"bearer")
PLACEHOLDERS = re.compile(rb"(?i)^(x+|\*+|\.+|-+|null|none|true|false|changeme|placeholder|example.*|your.*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)$")

ADDRESS = re.compile(rb"(?i)^[a-z][a-z0-9+.-]*://[^@]*$")
GENERIC = frozenset("value values default data text plain plaintext raw content current string".split())
TRIPLE, STRING, WORD, OPERATOR, LINE = range(1, 6)
KEY_BYTES, KEY_PARTS = 4_096, 256  # a key has no more; a longer value's parts are judged one by one
START = re.compile(rb"""("{3}|'{3})|(["`]|(?<![A-Za-z0-9])')|([A-Za-z0-9_$][A-Za-z0-9_.$-]*)|(:=|=>|[=!<>]=|[=:+(){}\[\],;])|(\n)""")
TRIPLES = {b'"""': re.compile(rb'"""(?:\\.|[^\\])*?"""'), b"'''": re.compile(rb"'{3}(?:\\.|[^\\])*?'{3}")}
STRINGS = {b'"': re.compile(rb'"(?:\\.|[^"\\\n])*+"'), b"'": re.compile(rb"'(?:\\.|[^'\\\n])*+'"), b"`": re.compile(rb"`[^`\n]*+`")}
BARE = re.compile(rb"""[A-Za-z0-9_][^\s"'`,;(){}\[\]<>+]*""")
NAME = re.compile(rb"[A-Za-z_$][A-Za-z0-9_.$-]*")
ASSIGNS = (b"=", b":", b":=", b"=>")
OPENS, CLOSES = (b"(", b"{", b"["), (b")", b"}", b"]")
_PARTS = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitive(name: bytes) -> bool:
    parts = [p.lower().decode() for p in _PARTS.findall(name)]
    return any(p in SENSITIVE for p in parts) or any(p in SENSITIVE_PAIRS for p in zip(parts, parts[1:], strict=False))


def key_like(value: bytes, quoted: bool) -> float:
    """0 for what no key looks like, else bits of entropy per byte."""
    if not 8 <= len(value) <= KEY_BYTES or PLACEHOLDERS.match(value) or ADDRESS.match(value) or b" " in value:
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    mixed = sum(bool(re.search(p, value)) for p in (rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[^A-Za-z0-9]"))
    return bits if bits >= 2.5 and mixed >= (2 if quoted else 3 - bool(re.search(rb"[0-9]", value))) else 0.0


def lex(data: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all tokens. A quote that nothing closes is none, and no later one of its kind is closed: on its line, or at all for a tripled one; so it isn't looked for again."""
    out, at, open_until, endless = [], 0, {}, set()
    while (m := START.search(data, at)) is not None:
        kind, a, at = m.lastindex, m.start(), m.end()
        if kind == TRIPLE:
            mark = m[0]
            whole = TRIPLES[mark].match(data, a) if mark not in endless else None
            if whole is None:
                endless.add(mark)
                kind, at = STRING, a + 2  # an empty string
            else:
                at = whole.end()
        elif kind == STRING:
            mark = m[0]
            whole = STRINGS[mark].match(data, a) if open_until.get(mark, -1) <= a else None
            if whole is None:
                if open_until.get(mark, -1) <= a:
                    end = data.find(b"\n", a)
                    open_until[mark] = len(data) if end < 0 else end
                continue
            at = whole.end()
        out.append((kind, a, at))
    return out


class Reader:
    """The pairs of one text: ``for name, outer, terms in Reader(data)``, a term being (start, end, quoted) in bytes, ``outer`` the nearest sensitive name that encloses the pair.

    Each token is looked at a bounded number of times: brackets are matched once, and a call is read whole only if no pair stands in it.
    """

    def __init__(self, data: bytes):
        self.data, self.constants, self.tokens = data, {}, lex(data)
        n = len(self.tokens)
        self.ops = [data[a:b] if kind == OPERATOR else b"" for kind, a, b in self.tokens]
        self.match, self.strings, self.pairs = [n] * n, [0] * (n + 1), [0] * (n + 1)  # the other bracket; strings, and assignments and braces, before each token
        stack, strings, pairs = [], 0, 0
        for i, text in enumerate(self.ops):
            if not text:
                strings += self.tokens[i][0] <= STRING
            elif text in OPENS:
                stack.append(i)
                pairs += text == b"{"
            elif text in CLOSES:
                self.match[i] = stack.pop() if stack else -1
                if self.match[i] >= 0:
                    self.match[self.match[i]] = i
            else:
                pairs += text in ASSIGNS
            self.strings[i + 1], self.pairs[i + 1] = strings, pairs

    def is_(self, i: int, *texts: bytes) -> bool:
        return 0 <= i < len(self.ops) and self.ops[i] in texts

    def kind(self, i: int) -> int:
        return self.tokens[i][0] if 0 <= i < len(self.tokens) else 0

    def inner(self, i: int) -> tuple[int, int, bool]:
        kind, a, b = self.tokens[i]
        cut = {TRIPLE: 3, STRING: 1}.get(kind, 0)
        return a + cut, b - cut, cut > 0

    def name(self, i: int) -> bytes | None:
        """A word or quoted text that can be a name."""
        if self.kind(i) not in (STRING, WORD):
            return None
        a, b, _ = self.inner(i)
        return self.data[a:b] if NAME.fullmatch(self.data, a, b) else None

    def left(self, i: int) -> bytes | None:
        """What the operator at i assigns to."""
        end = i - 1
        if self.is_(end, b"]"):
            start = self.match[end]
            if not self.is_(start, b"["):
                return None
            if end - start == 2 and self.kind(start + 1) == STRING:
                return self.name(start + 1)
            end = start - 1  # a type with parameters, or an element by number
        own = self.name(end)
        if own is not None and self.is_(i, b"=") and self.is_(end - 1, b":"):
            return self.name(end - 2) or own  # name: type = value
        return own

    def right(self, i: int) -> tuple[list[tuple[int, int, bool]], int]:
        """The terms of the value after the operator at i, and the token after them."""
        data, terms, j = self.data, [], i + 1
        below = inside = False
        while self.kind(j) == LINE:
            below, j = True, j + 1
        while True:
            if self.is_(j, b"("):
                inside, j = True, j + 1
                continue
            kind = self.kind(j)
            if kind in (TRIPLE, STRING):
                terms.append(self.inner(j))
                j += 1
            elif kind == WORD and self.is_(j + 1, b"(") and self.tokens[j][2] == self.tokens[j + 1][1]:
                end = self.match[j + 1]
                if self.pairs[end] > self.pairs[j + 2]:  # pairs of its own: only the call's own arguments count, and the call is read on
                    k = j + 2
                    while k < end:
                        if self.kind(k) in (TRIPLE, STRING):
                            terms.append(self.inner(k))
                        k = self.match[k] + 1 if self.is_(k, *OPENS) else k + 1
                    j += 1
                    break
                if self.strings[end] > self.strings[j + 2]:
                    terms += [self.inner(k) for k in range(j + 2, end) if self.kind(k) in (TRIPLE, STRING)]
                j = end + 1
            elif kind == WORD:
                a, b = self.tokens[j][1:]
                if data[a:b] in self.constants:
                    terms += self.constants[data[a:b]]
                    j += 1
                else:
                    m = BARE.match(data, a)
                    end = m.end() if m else b
                    terms.append((a, a + len(data[a:end].rstrip(b".:!?")), False))
                    j += 1
                    while j < len(self.tokens) and self.tokens[j][1] < end:
                        j += 1
            else:
                break
            if below and self.is_(j, *ASSIGNS):
                return [], i + 1  # the next line has a pair of its own
            while inside and self.kind(j) == LINE:
                j += 1
            if self.is_(j, b"+"):
                j += 1
            elif self.kind(j) not in (TRIPLE, STRING):
                break
        return terms, j

    def __iter__(self) -> Iterator[tuple[bytes, bytes | None, list[tuple[int, int, bool]]]]:
        scopes: list[tuple[bytes, bytes | None, bytes | None]] = []  # bracket, own name, nearest sensitive name
        i, opening, n, ops, tokens = 0, None, len(self.tokens), self.ops, self.tokens
        while i < n:
            op = ops[i]
            if not op:
                if tokens[i][0] == STRING and scopes and scopes[-1][0] == b"[" and scopes[-1][1] and not self.is_(i + 1, *ASSIGNS):
                    yield scopes[-1][1], scopes[-1][2], [self.inner(i)]
            elif op in ASSIGNS:
                name, opening = self.left(i) if not self.data.startswith(b"//", tokens[i][2]) else None, None
                if name is not None:
                    terms, after = self.right(i)
                    if terms:
                        yield name, scopes[-1][2] if scopes else None, terms
                        held = [t for t in terms if t[1] > t[0]]
                        if all(quoted for *_, quoted in terms) and len(held) <= KEY_PARTS and sum(b - a for a, b, _ in held) <= KEY_BYTES:
                            self.constants[name] = held
                        else:
                            self.constants.pop(name, None)
                        i = after
                        continue
                    opening = name
            elif op in OPENS:
                outer = scopes[-1][2] if scopes else None
                scopes.append((op, opening, opening if opening and sensitive(opening) else outer))
                opening = None
            elif op in CLOSES and scopes:
                scopes.pop()
            i += 1


def literals(data: bytes) -> list[tuple[int, int, bytes, float]]:
    """(start, end, name, score) of literals that sensitive names get, in bytes."""
    found: dict[tuple[int, int], tuple[bytes, float]] = {}
    for own, outer, terms in Reader(data):
        name = own if sensitive(own) else outer if own.lower().decode("utf-8", "replace") in GENERIC else None
        if name is None:
            continue
        whole = len(terms) <= KEY_PARTS and sum(b - a for a, b, _ in terms) <= KEY_BYTES
        for group in [terms] if whole else [[t] for t in terms]:
            score = key_like(b"".join(data[a:b] for a, b, _ in group), all(q for *_, q in group))
            if score:
                for a, b, _ in group:
                    if b > a:
                        found.setdefault((a, b), (name, score))
    return [(a, b, *v) for (a, b), v in found.items()]


def scan_text(data: bytes) -> list[tuple[str, int, int, str | None, float | None]]:
    """(kind, start, end, name, score) of all spans by start, then kind as listed, in code points."""
    lower = data.lower()
    spans: list[tuple[int, int, int, bytes | None, float | None]] = []
    if any(h in lower for h in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end(), m[1], None) for m in ASSIGN.finditer(data) if len(m[2]) >= 8]
    if b"AKIA" in data:
        spans += [(m.start(), 1, m.end(), None, None) for m in ACCESS.finditer(data) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), None, None) for m in HEX.finditer(data)]
    if any(h in lower for h in LITERAL_HINTS):
        base = [sorted((s[0], s[2]) for s in spans if s[1] == k) for k in range(3)]  # a kind's spans don't overlap
        covered = lambda a, b: any((at := bisect_right(own, (a, len(data) + 1)) - 1) >= 0 and b <= own[at][1] for own in base)
        spans += [(a, 3, b, name, score) for a, b, name, score in literals(data) if not covered(a, b)]
    spans.sort(key=lambda s: (s[0], s[1], s[2]))
    if data.isascii():
        return [(KINDS[k], a, b, n and n.decode(), s) for a, k, b, n, s in spans]
    place, at, chars = {}, 0, 0
    for p in sorted({p for s in spans for p in (s[0], s[2])}):
        chars += len(data[at:p].decode("utf-8", "replace"))
        place[p], at = chars, p
    return [(KINDS[k], place[a], place[b], n and n.decode(), s) for a, k, b, n, s in spans]


FINDING = "array<struct<kind:string,start:long,end:long,name:string,score:double>>"
_FINDING = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))


def _findings(texts: pa.Array) -> list[list[tuple]]:
    return [scan_text(t) if t else [] for t in texts.cast(pa.large_binary()).to_pylist()]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and findings, an array of (kind, start, end, name, score), of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ("kind", "start", "end", "name", "score")
        for batch in batches:
            found = [[dict(zip(keys, f, strict=True)) for f in row] for row in _findings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _FINDING)], names=["doc_id", "findings"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, findings {FINDING}")


def spelled(findings: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f.kind, f.start.cast("string"), f.end.cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    n = lambda kind: F.size(F.filter("findings", lambda f: f.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("findings", lambda f: f.kind != "literal")
    return scanned.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("findings")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; in ``text`` each span, or run of overlapping ones, is replaced by ``mark``; ``n_chars`` follows if there."""
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, texts = batch.columns, batch.column(at).to_pylist()
            lengths = columns[size].to_pylist() if size is not None else []
            for i, found in enumerate(_findings(batch.column(at))):
                if found:
                    out, end, text = [], 0, texts[i]
                    for _, a, b, *_ in found:
                        if a >= end:
                            out += [text[end:a], mark]
                        end = max(end, b)
                    texts[i] = "".join(out) + text[end:]
                    if size is not None:
                        lengths[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if size is not None:
                columns[size] = pa.array(lengths, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
