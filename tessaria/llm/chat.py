"""Chat formatting: a small sandboxed template language, compiled to Python closures, over grouped conversations."""

from __future__ import annotations

import ast
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks turns; the text of an assistant's turn alone is under the generation marker, and so under the loss mask.
TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' ~ (m.role|header) ~ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}{% else %}{{ m.text|escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}{% endfor %}"
)
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash more goes between the two; ``unescape`` takes one away."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def header(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unheader(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


#: All that a template can call: pure functions of one string.
FILTERS = {"escape": escape, "header": header, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template isn't in the language."""


_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z]\w*)|(?P<op>==|!=|<=|>=|[-+~|.()\[\]<>]))""")
_PARTS = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_BINARY = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">="), ("+", "-", "~"))
_APPLY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "~": lambda a, b: f"{a}{b}",
}


class _Expression:
    """Recursive descent over one expression; the tree is made of tuples whose first item is the kind."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected text: {source[at:]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][1] in wanted and self.tokens[self.at][0] != "str":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self):
        tree = self.binary(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def binary(self, level: int):
        if level == len(_BINARY):
            return self.unary()
        left = self.binary(level + 1)
        while op := self.take(*_BINARY[level]):
            left = ("bin", op, left, self.binary(level + 1))
        return left

    def unary(self):
        if self.take("not"):
            return ("not", self.unary())
        tree = self.atom()
        while op := self.take(".", "[", "|"):
            if op == "[":
                tree = ("get", tree, self.binary(0))
                if not self.take("]"):
                    raise TemplateError("] is missing")
                continue
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            self.at += 1
            if kind != "name" or (op == "|" and name not in FILTERS):
                raise TemplateError(f"unknown filter or field {name!r}")
            tree = ("get", tree, ("const", name)) if op == "." else ("filter", name, tree)
        return tree

    def atom(self):
        if self.take("("):
            tree = self.binary(0)
            if not self.take(")"):
                raise TemplateError(") is missing")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too soon")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind in ("str", "int"):
            return ("const", ast.literal_eval(value))
        if kind == "name":
            return ("const", {"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else ("var", value)
        raise TemplateError(f"unexpected {value!r}")


def fold(tree):
    """Constant parts of an expression are worked out once."""
    kind = tree[0]
    if kind in ("const", "var"):
        return tree
    args = tuple(fold(x) if isinstance(x, tuple) else x for x in tree[1:])
    parts = [x for x in args if isinstance(x, tuple)]
    tree = (kind, *args)
    return ("const", _value(tree)({})) if all(x[0] == "const" for x in parts) else tree


def _value(tree):
    """An expression as a closure of the variables."""
    kind = tree[0]
    if kind == "const":
        return lambda env, v=tree[1]: v
    if kind == "var":
        return lambda env, n=tree[1]: env.get(n)
    if kind == "not":
        return lambda env, f=_value(tree[1]): not f(env)
    if kind == "filter":
        return lambda env, g=FILTERS[tree[1]], f=_value(tree[2]): g("" if (v := f(env)) is None else str(v))
    if kind == "get":

        def get(env, f=_value(tree[1]), g=_value(tree[2])):
            held, key = f(env), g(env)
            if isinstance(held, dict):
                return held.get(key)
            return held[key] if isinstance(held, list | str) and isinstance(key, int) and -len(held) <= key < len(held) else None

        return get
    op, left, right = tree[1], _value(tree[2]), _value(tree[3])
    if op == "and":
        return lambda env: left(env) and right(env)
    if op == "or":
        return lambda env: left(env) or right(env)
    return lambda env, f=_APPLY[op]: f(left(env), right(env))


def parse(source: str) -> list:
    """The statements of a template: ("text", s), ("out", e), ("set", n, e), ("for", n, e, body), ("if", [(e, body)]), ("gen", body)."""
    items: list[tuple[str, str]] = []
    at = 0
    trim = False
    for m in [*_PARTS.finditer(source), None]:
        between = source[at : m.start()] if m else source[at:]
        between = between.lstrip() if trim else between
        if m is None:
            items.append(("text", between))
            break
        items.append(("text", between.rstrip() if m[0][2] == "-" else between))  # a minus at a tag takes the white space beside it
        if m[1] is not None:
            items.append(("out", m[1]))
        elif m[2] is not None:
            items.append(("tag", m[2].strip()))
        at, trim = m.end(), m[0][-3] == "-"
    place = 0

    def body(*ends: str) -> tuple[list, str]:
        nonlocal place
        found: list = []
        while place < len(items):
            kind, value = items[place]
            place += 1
            if kind == "text":
                if value:
                    found.append(("text", value))
            elif kind == "out":
                tree = fold(_Expression(value).whole())
                found.append(("text", str(tree[1])) if tree[0] == "const" else ("out", tree))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return merged(found), value
                if word == "for" and (m := re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip())):
                    found.append(("for", m[1], fold(_Expression(m[2]).whole()), body("endfor")[0]))
                elif word == "set" and (m := re.fullmatch(r"(\w+)\s*=\s*(.+)", rest.strip())):
                    found.append(("set", m[1], fold(_Expression(m[2]).whole())))
                elif word == "generation" and not rest:
                    found.append(("gen", body("endgeneration")[0]))
                elif word == "if":
                    cases, test = [], fold(_Expression(rest).whole())
                    while True:
                        inner, end = body("elif", "else", "endif")
                        cases.append((test, inner))
                        if end == "endif":
                            break
                        test = ("const", True) if end == "else" else fold(_Expression(end[4:]).whole())
                    found.append(("if", cases))
                else:
                    raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return merged(found), ""

    def merged(found: list) -> list:
        out: list = []
        for x in found:
            if x[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + x[1])
            else:
                out.append(x)
        return out

    return body()[0]


class _Output:
    def __init__(self):
        self.parts: list[str] = []
        self.size = 0
        self.mask: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _closure(statements: list):
    steps = []
    for s in statements:
        kind = s[0]
        if kind == "text":
            steps.append(lambda env, out, t=s[1]: out.add(t))
        elif kind == "out":
            steps.append(lambda env, out, f=_value(s[1]): out.add("" if (v := f(env)) is None else str(v)))
        elif kind == "set":
            steps.append(lambda env, out, n=s[1], f=_value(s[2]): env.__setitem__(n, f(env)))
        elif kind == "gen":

            def gen(env, out, f=_closure(s[1])):
                begin = out.size
                f(env, out)
                out.mask.append((begin, out.size))

            steps.append(gen)
        elif kind == "if":

            def choose(env, out, cases=tuple((_value(t), _closure(b)) for t, b in s[1])):
                for test, f in cases:
                    if test(env):
                        return f(env, out)

            steps.append(choose)
        else:

            def loop(env, out, name=s[1], items=_value(s[2]), f=_closure(s[3])):
                held = list(items(env) or [])
                for i, x in enumerate(held):
                    f(env | {name: x, "loop": {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(held) - 1, "length": len(held)}}, out)

            steps.append(loop)

    def run(env, out):
        for step in steps:
            step(env, out)

    return run


@cache
def compiled(source: str):
    """messages -> (text, code point ranges under the generation marker)."""
    run = _closure(parse(source))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run({"messages": messages}, out)
        return "".join(out.parts), out.mask

    return render


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, as they were."""
    turns = []
    for piece in formatted.split(START)[1:]:
        role, _, rest = piece.partition("\n")
        turns.append((unheader(role), unescape(rest[: rest.rfind(END)])))
    return turns


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_TURN = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def format_conversations(rows: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``formatted`` and ``mask`` (code point ranges of what a model is trained on), one row a conversation.

    Turns go by turn, then role and text; null turns come first; a null role or text is empty; rows that repeat are
    turns of their own; rows without a conversation form one. Other columns play no part; an empty table gives no rows.
    A conversation is one text, so its turns are gathered in one row of one task, however long they are.
    """
    compiled(template)  # a wrong template fails here
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("n"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))))
    grouped = rows.groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(turns.alias("turns"))

    def run(it):
        render = compiled(template)
        for batch in it:
            done = [render(t) for t in batch.column("turns").to_pylist()]
            mask = pa.array([[{"start": a, "end": b} for a, b in m] for _, m in done], _SPAN)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array([t for t, _ in done], pa.string()), mask], ["conv_id", "formatted", "mask"])

    return grouped.mapInArrow(run, "conv_id long, formatted string, mask array<struct<start:int,end:int>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` plus ``turns`` (role, text) and ``learned``: the unescaped pieces under the mask.

    ``formatted`` is what format_conversations gives, so it holds no nulls: null and empty texts come back as empty ones,
    texts that hold marks or escapes as they were, however long. A conversation without turns has empty lists; rows are
    read one by one, so repeated ones give equal results; an empty table gives no rows.
    """

    def run(it):
        for batch in it:
            texts = batch.column("formatted").to_pylist()
            turns = pa.array([[{"role": r, "text": t} for r, t in read(x)] for x in texts], _TURN)
            learned = pa.array([[unescape(x[m["start"] : m["end"]]) for m in mask] for x, mask in zip(texts, batch.column("mask").to_pylist(), strict=True)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, turns, learned], [*batch.schema.names, "turns", "learned"])

    return formatted.mapInArrow(run, "conv_id long, formatted string, mask array<struct<start:int,end:int>>, turns array<struct<role:string,text:string>>, learned array<string>")
