"""Secret scans: pattern matches, and literals that reach a sensitive name through assignments."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ends_clean, fields, named, passing, whole_texts

#: The base patterns, matched in this order of kinds, and the least length of a match (of group 2 for assign).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters: a shorter run holds no longer one
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "flow")

#: How much a part of a name says that its value is secret.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "secrets": 3, "credential": 3, "credentials": 3, "token": 2, "apikey": 3,
    "private": 2, "auth": 1, "access": 1, "api": 1, "signing": 1, "encryption": 1, "client": 1, "key": 1, "pass": 2, "bearer": 2, "cookie": 1, "session": 1, "db": 1,
}
#: Values that stand for a secret to be filled in: what they hold, what they are as a whole, or begin and end with.
PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|changeme|example|placeholder|your[_-]|dummy")
NOTHING = re.compile(r"(?i)todo|none|null|true|false|undefined")
ENCLOSED = (("<", ">"), ("${", "}"), ("%(", ")s"))
#: Characters at the ends of a value that a placeholder may begin or end in.
EDGE = 16
#: Name and literal must score so much together.
LEAST_SCORE = 4.0

#: Names count by so many characters at their end.
LONGEST_NAME = 200
#: Strings of one line, three quotes or one on either side; a prefix such as f, b, r, L or @ may stand before.
STRINGS = {q: rf"{q * 3}(?:[^{q}\\\n]|\\.|{q}(?!{q * 2}))*+{q * 3}|{q}(?:[^{q}\\\n]|\\.)*+{q}" for q in ('"', "'")}
PREFIX = r"(?:[fFbBrRuU][fFbBrR]?|L|u8|@\$?|\$@?)?"
QUOTE = re.compile(PREFIX + r"""("{3}|'{3}|["'])""")


def _token(closed: str) -> re.Pattern:
    """Tokens of a line in which the quotes in ``closed`` may still begin strings."""
    text = "|".join(STRINGS[q] for q in closed)
    return re.compile(rf"""{f"(?P<str>{PREFIX}(?:{text}))|" if text else ""}(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]*)|(?P<op>:=|=>|==|!=|\+=|[:=+,;{{}}()\[\]\n])|(?P<other>[^\s"'A-Za-z_$:=+,;{{}}()\[\]]+)|(?P<quote>["'])""")


TOKENS = {closed: _token(closed) for closed in ("\"'", '"', "'", "")}
LINE = re.compile(r"""^[^\n]*(?:[A-Za-z0-9_$"'\]>)?][ \t]*(?::=|=>|\+=|[:=])[ \t]*[^\s=:])[^\n]*""", re.MULTILINE)
ASSIGNS = (":=", "=>", "+=", ":", "=")
#: A line of configuration: a name, an operator and one unquoted value up to the line's end or a comment.
CONFIG = re.compile(r"""[ \t]*(?:-[ \t]+)?(?P<word>export[ \t]+|set[ \t]+|ENV[ \t]+|\$env:)?["']?(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]{0,199})["']?(?P<op>[ \t]*(?::=|=>|[:=])[ \t]*)(?P<value>[^\s"'`$:=][^\s"'`]*?)[;,]?[ \t\r]*(?:[ \t](?:#|//|;)[^\n]*)?$""", re.MULTILINE)
ENVIRONMENT = re.compile(r"[A-Z][A-Z0-9_]*")
#: What stands left of an operator, from its end: a key in brackets, an array's name, a name before a type.
NAME = r"[A-Za-z_$][A-Za-z0-9_$.-]{0,199}"
KEYED = re.compile(r"""["'][ \t]*\]$""")
ARRAY = re.compile(rf"({NAME})[ \t]*\[\d*\]$")
TYPED = re.compile(rf"""({NAME})["']?[?!]?[ \t]*:[ \t]*[&*]?(?:'[a-z]+[ \t]+)?[A-Za-z_][A-Za-z0-9_.:<>\[\], |?&*]{{0,190}}$""")
NAMED = re.compile(rf"({NAME})[ \t]+\*?(?:\[\])?({NAME})$")
PLAIN = re.compile(rf"({NAME})$")
#: Functions that join their arguments.
JOINS = frozenset("concat concatenate strcat join".split())
#: A block of a configuration: a name, a bar or an angle, and lines that are indented more than the name's.
BLOCK = re.compile(rf"""^(?P<indent>[ \t]*)(?:-[ \t]+)?["']?(?P<name>{NAME})["']?[ \t]*:[ \t]*[|>][0-9]?[+-]?[ \t]*\r?\n(?P<body>(?:(?P=indent)[ \t]+[^\n]*(?:\n|\Z)|[ \t]*\n)+)""", re.MULTILINE)
#: Markup: a tag with its attributes, and what stands between a tag without attributes and its end.
TAG = re.compile(r"<[A-Za-z][^<>]*>")
ATTRIBUTE = re.compile(r"""([A-Za-z_][A-Za-z0-9_:.-]*)[ \t]*=[ \t]*(?:"([^"]*)"|'([^']*)')""")
ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*)>([^<>\s]+)</\1>")
ATTRIBUTE_NAMES, ATTRIBUTE_VALUES = ("key", "name", "id"), ("value", "content")
TYPES = frozenset("str string String bytes byte char text Text AnyStr SecretStr Secret".split())


def name_score(name: str) -> float:
    parts = re.findall(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+", name)
    words = [p.lower() for p in parts]
    joined = [a + b for a, b in zip(words, words[1:], strict=False)]
    return min(4.0, sum(SENSITIVE.get(w, 0) for w in {*words, *joined}))


class Value:
    """What a value's score needs, without its text: it is made of a literal, or of two values, whose places it shares."""

    __slots__ = ("span", "left", "right", "n", "counts", "plain", "filled", "marks", "head", "tail", "inner", "blank")

    @classmethod
    def literal(cls, value: str, span: tuple[int, int] | None = None) -> Value:
        v = cls()
        v.span, v.left, v.right = span, None, None
        v.n, v.counts, v.plain = float(len(value)), Counter(value), value.isprintable()
        v.filled = bool(PLACEHOLDER.search(value)) or any(0 <= value.find(a) < value.rfind(b) for a, b in ENCLOSED)
        v.marks = frozenset(m for pair in ENCLOSED for m in pair if m in value)
        v.head, v.tail = value[:EDGE], value[-EDGE:]
        v.inner, v.blank = " " in value.strip(), not value.strip()
        return v

    def __add__(self, more: Value) -> Value:
        v = Value()
        v.span, v.left, v.right = None, self, more
        v.n, v.counts, v.plain = self.n + more.n, Counter(self.counts), self.plain and more.plain
        for c, k in more.counts.items():
            v.counts[c] += k
        if v.n > 1e290:  # only proportions count
            v.n, v.counts = v.n / 1e9, Counter({c: k / 1e9 for c, k in v.counts.items()})
        met = self.tail + more.head
        across = {m for pair in ENCLOSED for m in pair if len(m) == 2 and self.tail[-1:] + more.head[:1] == m}
        opened, closed = self.marks | across, more.marks | across
        v.filled = self.filled or more.filled or bool(PLACEHOLDER.search(met)) or any(a in opened and b in closed and (a in self.marks or b in more.marks) for a, b in ENCLOSED)
        v.marks = self.marks | more.marks | across
        v.head, v.tail = (self.head + more.head)[:EDGE], (self.tail + more.tail)[-EDGE:]
        between = not self.blank and not more.blank and (self.tail[-1:] == " " or more.head[:1] == " ")
        v.inner, v.blank = self.inner or more.inner or between, self.blank and more.blank
        return v

    def score(self) -> float:
        """0 for what isn't a secret's value; more for long and mixed ones."""
        n = self.n
        if n <= EDGE and NOTHING.fullmatch(self.head):
            return 0.0
        if n < 6 or self.inner or self.blank or self.filled or not self.plain:
            return 0.0
        entropy = -sum(p * math.log2(p) for c in self.counts.values() if (p := c / n) > 0)
        classes = sum(any(f(c) for c in self.counts) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in self.counts)
        return (n >= 8) * 0.5 + (n >= 16) * 0.5 + max(0.0, entropy - 2) * 0.5 + (classes - 1) * 0.5


def literal_score(value: str) -> float:
    return Value.literal(value).score()


def lexed(text: str) -> list[tuple[int, int, str]]:
    """Tokens of the lines that hold an assignment: start, end, kind."""
    found = []
    for line in LINE.finditer(text):
        closed, at = "\"'", line.start()
        while at < line.end():
            for m in TOKENS[closed].finditer(text, at, line.end()):
                found.append((m.start(), m.end(), m.lastgroup or ""))
                at = m.end()
                if m.lastgroup == "quote" and m[0] in closed:  # no string begins here, so none begins at a later one of its kind
                    closed = closed.replace(m[0], "")
                    break
            else:
                break
        found.append((line.end(), line.end(), "end"))
    return found


def targets(text: str, start: int, end: int, op: str) -> list[str]:
    """Names that an operator at ``end`` gives a value, from what stands left of it in its line."""
    left = text[max(start, end - LONGEST_NAME) : end].rstrip(" \t")
    if m := KEYED.search(left):  # a longer key counts by its end
        k = left.rfind(left[m.start()], 0, m.start())
        return [left[k + 1 : m.start()]] if k < 0 or left[:k].rstrip(" \t").endswith("[") else []
    if m := ARRAY.search(left):
        return [m[1]]
    found = []
    if left[-1:] in ("'", '"') and (k := left.rfind(left[-1], 0, -1)) >= 0:
        return [left[k + 1 : -1]]
    bare = left.rstrip("\"'")
    if op == "=" and (m := TYPED.search(left)):
        found.append(m[1])
    if m := PLAIN.search(bare):
        if (typed := NAMED.search(bare)) and typed[2] in TYPES and not found:
            return [typed[1]]
        if not (found and m[1] in TYPES):
            found.append(m[1])
    return found


def unquoted(line: re.Match) -> bool:
    """Whether a line of configuration gives a value, not the name of one."""
    name, op, value = line["name"], line["op"], line["value"]
    if line["word"] or (ENVIRONMENT.fullmatch(name) and (op == "=" or op.strip() == ":")):
        return True
    return any(c.isdigit() for c in value) and not any(c in "()[]{}<>" for c in value)


def flows(text: str) -> list[tuple[int, int]]:
    """Literals that are assigned, directly, in a sum or through constants, to a sensitive name: their spans, quotes excluded.

    Constants are known by name, for the whole text from where they are given on. Reads ``name = value``, ``name: value``, ``"name": value``, ``name := value``, ``name => value``, ``name += value``,
    ``name: type = value``, ``name type = value`` and ``a["name"] = value``; a value is a quoted string or a name that
    an earlier line gave a value, or several side by side, joined by ``+`` or by a function such as ``concat``, of which
    unknown ones are passed over; strings may have prefixes and three quotes. Blocks of lines below ``name: |``, markup
    such as ``<add key="name" value="..."/>`` and ``<name>...</name>`` count too. A line of
    configuration may leave out the quotes: such a value reaches to the end of its token, and holds a digit unless the
    name is that of an environment variable (``NAME=value``), as it could name a variable otherwise.
    """
    tokens = lexed(text)
    word = lambda k: text[tokens[k][0] : tokens[k][1]]
    close: dict[int, int] = {}  # of each bracket in its line
    first: list[int] = []  # place where the token's line begins
    opened: list[int] = []
    begin = tokens[0][0] if tokens else 0
    for k, (a, _, kind) in enumerate(tokens):
        first.append(begin)
        if kind == "end":
            opened = []
            begin = tokens[k + 1][0] if k + 1 < len(tokens) else a
        elif kind == "op" and text[a] in "([{":
            opened.append(k)
        elif kind == "op" and text[a] in ")]}" and opened:
            close[opened.pop()] = k
    known: dict[str, Value] = {}
    told: set[int] = set()
    kept: list[Value] = []  # those in told, so that their ids stay theirs
    spans: list[tuple[int, int]] = []

    def give(names: list[str], value: Value) -> None:
        known.update((name, value) for name in names)
        named, literal = max(map(name_score, names)), value.score()
        if named >= 2 and literal > 0 and named + literal >= LEAST_SCORE:
            todo = [value]
            while todo:
                v = todo.pop()
                if v is None or id(v) in told:
                    continue
                told.add(id(v))
                kept.append(v)
                if v.span:
                    spans.append(v.span)
                todo += (v.left, v.right)

    def literal(s: int, e: int) -> Value:
        q = QUOTE.match(text, s, e)
        span = (q.end(), e - len(q[1]))
        return Value.literal(text[span[0] : span[1]], span)

    def joined(k: int, until: int) -> Value | None:
        value = None
        for s, e, kind in tokens[k:until]:
            part = literal(s, e) if kind == "str" else known.get(text[s:e]) if kind == "name" else None
            if part is not None:
                value = part if value is None else value + part
        return value

    i, at, line = 0, -1, None
    while i < len(tokens):
        a, b, kind = tokens[i]
        if kind == "op" and text[a:b] in ASSIGNS and i and tokens[i - 1][2] != "end":
            value, j = None, i + 1
            while j < len(tokens):
                s, e, kind = tokens[j]
                part = literal(s, e) if kind == "str" else known.get(text[s:e]) if kind == "name" else None
                if kind == "name" and text[s:e].rpartition(".")[2].lower() in JOINS and j + 1 in close:
                    part = joined(j + 2, close[j + 1])
                if part is not None:
                    value = part if value is None else value + part
                if kind == "str" and part.n == 0 and j + 3 in close and text[e : tokens[j + 2][1]].replace(" ", "") == ".join":
                    more = joined(j + 4, close[j + 3])
                    value = more if value is part else value if more is None else value + more
                if kind == "str" and j + 1 < len(tokens) and tokens[j + 1][2] == "str":  # side by side they are one
                    j += 1
                    continue
                while j < len(tokens) and tokens[j][2] != "end":  # to the next + of this sum
                    w = word(j)
                    if w == "+" or w in ASSIGNS or w in (",", ";", ")", "]", "}") or (w in ("(", "[", "{") and j not in close):
                        break
                    j = close.get(j, j) + 1
                if j >= len(tokens) or word(j) != "+":
                    break
                j += 1
            if value is not None and (names := targets(text, first[i], a, text[a:b])):
                if text[a:b] == "+=":
                    value = next((known[n] + value for n in names if n in known), value)
                give(names, value)
            elif value is None:
                if at != first[i]:
                    at, line = first[i], CONFIG.match(text, first[i])
                if line and line.start("op") <= a < line.end("op") and unquoted(line):
                    give([line["name"]], Value.literal(line["value"], line.span("value")))
        i += 1
    for m in BLOCK.finditer(text) if ":" in text else ():
        value = None
        for part in re.finditer(r"[^\s][^\n]*", m["body"]):
            line = part[0].rstrip()
            if not line.startswith("-----"):  # the frame of a key
                begin = m.start("body") + part.start()
                one = Value.literal(line, (begin, begin + len(line)))
                value = one if value is None else value + one
        if value is not None:
            give([m["name"]], value)
    if "<" in text:
        for m in TAG.finditer(text):
            if m[0].count("=") > 1:
                held = {a[1].lower(): a for a in ATTRIBUTE.finditer(m[0])}
                name, value = (next((held[k] for k in kinds if k in held), None) for kinds in (ATTRIBUTE_NAMES, ATTRIBUTE_VALUES))
                if name and value:
                    k = 2 if value[2] is not None else 3
                    give([name[2] if name[2] is not None else name[3]], Value.literal(value[k], (m.start() + value.start(k), m.start() + value.end(k))))
        for m in ELEMENT.finditer(text):
            give([m[1]], Value.literal(m[2], m.span(2)))
    return sorted({s for s in spans if s[1] > s[0]})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, place of the kind in KINDS, end."""
    found: list[tuple[int, int, int]] = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans, in order. A literal inside a base span isn't named again."""
    base = sorted(base_spans(text))
    more = []
    if "=" in text or ":" in text or "</" in text:
        begins, ends = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
        more = [(s, 3, e) for s, e in flows(text) if not (k := bisect_right(begins, s)) or ends[k - 1] < e]
    return base, sorted(base + more) if more else base


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but for the text, plus ``n_assign``, ``n_access``, ``n_hex``, ``n_flow``, ``base`` and ``spans``.

    Spans are kind:start:end in code points, end exclusive, by start and kind, joined by commas. Base kinds are leftmost
    matches that don't overlap within their kind. ``flow`` is a literal whose value reaches a sensitive name.
    A null text is empty and has none; repeated rows stay; an empty table gives no rows; columns called like a result
    are replaced. Whole texts are read, in time that grows with their length; a name counts by its last 200
    characters. Comments are read like code, as secrets in them are no safer.
    """
    made = ("n_assign", "n_access", "n_hex", "n_flow", "base", "spans")
    rest = [c for c in docs.columns if c != text_col and c not in made]
    source = docs.select(*passing(rest), F.coalesce(named(text_col), F.lit("")).alias("__text"))

    def run(it):
        for batch in it:
            found = [scan(t) for t in batch.column("__text").to_pylist()]
            counts = [pa.array([sum(x[1] == k for x in every) for _, every in found], pa.int64()) for k in range(4)]
            texts = [pa.array([_joined(x[i]) for x in found], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(rest))), *counts, *texts], [*rest, *made])

    return whole_texts(source).mapInArrow(ends_clean(run), ", ".join([*fields(docs, rest), *(f"{c} long" for c in made[:4]), "base string", "spans string"]))
