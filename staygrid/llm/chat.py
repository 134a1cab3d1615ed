"""Operator 9: chat formatting with a small compiled template language.

A template has text, {{ expression }} and the statements for / if / elif / else / generation.
It is parsed into a tree, constants are folded, and the tree becomes nested Python closures: no
attribute of a Python object, no call and no name with an underscore can be written in it.
Rendering yields pieces of text, each with whether it is generated (under the loss mask), and a
loop over messages takes them one by one, so a conversation of any length streams through.

Expressions: strings, whole numbers, true, false, none; names; value.key and value['key'] of
dictionaries; ~ joins; == != ; and, or, not; filters escape, trim, upper, lower.

Defined cases: null text and role are empty; turns are ordered by (turn, role, text), a null
turn first; rows of a null conv_id are one conversation; repeated rows are repeated turns;
extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import materialize, parallelism, tune

TEMPLATE = (
    "{% for m in messages %}<turn {{ m.role | escape }}>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
#: Characters of formatted text after which a part ends, at the next turn.
PART = 1 << 16
_MARKS = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)


class TemplateError(ValueError):
    """A template that can't be compiled or rendered."""


def escape(text: str) -> str:
    """Put a backslash before backslashes and angle brackets, so no control string is left."""
    return _MARKS.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z][A-Za-z0-9_]*)|(?P<op>==|!=|[~|.\[\]()]))")
_CONSTANTS = {"true": True, "false": False, "none": None}

# Nodes of the tree: ("const", value) ("name", n) ("get", node, node) ("join", a, b) ("eq", a, b, same)
# ("and"|"or", a, b) ("not", a) ("filter", name, a); statements: ("text", s) ("show", e)
# ("for", name, e, body) ("if", [(test, body)...], otherwise) ("generation", body)


class _Expression:
    """A recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str | None, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else (None, "")

    def take(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("op", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing before {self.peek()[1]!r}")

    def parse(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        if op := self.take("==", "!="):
            node = ("eq", node, self.joined(), op == "==")
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.take("~"):
            node = ("join", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.value()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def value(self) -> tuple:
        kind, text = self.peek()
        self.at += 1
        if kind == "str":
            node = ("const", _ESCAPED.sub(lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1]))
        elif kind == "int":
            node = ("const", int(text))
        elif kind == "name" and text in _CONSTANTS:
            node = ("const", _CONSTANTS[text])
        elif kind == "name" and "_" not in text:
            node = ("name", text)
        elif text == "(":
            node = self.either()
            self.need(")")
        else:
            raise TemplateError(f"unexpected {text!r}")
        while op := self.take(".", "["):
            if op == ".":
                kind, text = self.peek()
                if kind != "name" or "_" in text:
                    raise TemplateError(f"no key {text!r}")
                self.at += 1
                node = ("get", node, ("const", text))
            else:
                node = ("get", node, self.either())
                self.need("]")
        return node


def parse(source: str) -> list[tuple]:
    """The tree of a template."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[list[tuple], str]:
        nonlocal at
        body: list[tuple] = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{"):
                body.append(("show", _Expression(piece[2:-2]).parse()))
            elif not piece.startswith("{%"):
                body.append(("text", piece))
            else:
                inner = piece[2:-2].strip()
                word, _, rest = inner.partition(" ")
                if word in ends:
                    return body, inner
                if word == "for":
                    m = re.fullmatch(r"([A-Za-z][A-Za-z0-9]*)\s+in\s+(.+)", rest.strip(), re.S)
                    if not m:
                        raise TemplateError(f"can't read {inner!r}")
                    inside, _ = block("endfor")
                    body.append(("for", m[1], _Expression(m[2]).parse(), inside))
                elif word == "if":
                    tests, otherwise, end = [], [], inner
                    while end != "endif":
                        if end == "else":
                            otherwise, end = block("endif")
                        else:
                            test = _Expression(end.partition(" ")[2]).parse()
                            inside, end = block("elif", "else", "endif")
                            tests.append((test, inside))
                    body.append(("if", tests, otherwise))
                elif word == "generation":
                    inside, _ = block("endgeneration")
                    body.append(("generation", inside))
                else:
                    raise TemplateError(f"no statement {inner!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return body, ""

    return block()[0]


def _as_text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool) or not isinstance(value, (str, int)):
        raise TemplateError(f"a {type(value).__name__} is no text")
    return str(value)


def _apply(kind: str, *values: object) -> object:
    if kind == "join":
        return _as_text(values[0]) + _as_text(values[1])
    if kind == "get":
        if not isinstance(values[0], dict):
            raise TemplateError("only dictionaries have keys")
        return values[0].get(values[1])
    return values[0] == values[1]


def fold_expression(node: tuple) -> tuple:
    kind = node[0]
    if kind in ("const", "name"):
        return node
    node = tuple(fold_expression(x) if isinstance(x, tuple) else x for x in node)
    inner = [x for x in node[1:] if isinstance(x, tuple)]
    if any(x[0] != "const" for x in inner) or kind == "get":
        return node
    return ("const", compile_expression(node)({}))


def fold(body: list[tuple]) -> list[tuple]:
    """The tree with constant expressions worked out, dead branches gone and texts joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        if node[0] == "show":
            e = fold_expression(node[1])
            add(("text", _as_text(e[1])) if e[0] == "const" else ("show", e))
        elif node[0] == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif node[0] == "generation":
            add(("generation", fold(node[1])))
        elif node[0] == "if":
            tests, otherwise = [], fold(node[2])
            for test, inside in node[1]:
                e = fold_expression(test)
                if e[0] != "const":
                    tests.append((e, fold(inside)))
                elif e[1]:
                    otherwise = fold(inside)
                    break
            for inner in [("if", tests, otherwise)] if tests else otherwise:
                add(inner)
        else:
            add(node)
    return out


def compile_expression(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]

        def look(scope: dict) -> object:
            if name not in scope:
                raise TemplateError(f"no name {name!r}")
            return scope[name]

        return look
    if kind == "filter":
        change, inner = FILTERS[node[1]], compile_expression(node[2])
        return lambda scope: change(_as_text(inner(scope)))
    a = compile_expression(node[1])
    if kind == "not":
        return lambda scope: not a(scope)
    b = compile_expression(node[2])
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    if kind == "eq":
        same = node[3]
        return lambda scope: (a(scope) == b(scope)) is same
    return lambda scope: _apply(kind, a(scope), b(scope))


#: Yielded between two rounds of an outermost loop.
CUT = (None, False)
Piece = tuple[str | None, bool]


def _compile(body: list[tuple], generated: bool, depth: int) -> Callable[[dict], Iterator[Piece]]:
    steps: list[Callable[[dict], Iterable[Piece]]] = []
    for node in body:
        if node[0] == "text":
            steps.append(lambda scope, piece=((node[1], generated),): piece)
        elif node[0] == "show":
            steps.append(lambda scope, e=compile_expression(node[1]): ((_as_text(e(scope)), generated),))
        elif node[0] == "generation":
            steps.append(_compile(node[1], True, depth))
        elif node[0] == "for":

            def loop(scope: dict, name: str = node[1], of=compile_expression(node[2]), inside=_compile(node[3], generated, depth + 1)) -> Iterator[Piece]:
                for value in of(scope):
                    yield from inside({**scope, name: value})
                    if not depth:
                        yield CUT

            steps.append(loop)
        else:
            tests = [(compile_expression(t), _compile(b, generated, depth)) for t, b in node[1]]

            def choose(scope: dict, tests=tests, otherwise=_compile(node[2], generated, depth)) -> Iterable[Piece]:
                return next((b for t, b in tests if t(scope)), otherwise)(scope)

            steps.append(choose)

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def compile_template(source: str) -> Callable[[dict], Iterator[Piece]]:
    """A function of the names' values that yields pieces of text and whether each is generated."""
    return _compile(fold(parse(source)), False, 0)


def _parts(pieces: Iterable[Piece]) -> Iterator[tuple[str, list[int]]]:
    """Formatted text in parts, with starts and ends of the loss mask's spans in each."""
    held, spans, size = [], [], 0
    for text, generated in pieces:
        if text is None:
            if size >= PART:
                yield "".join(held), spans
                held, spans, size = [], [], 0
            continue
        if generated and text:
            if spans and spans[-1] == size:
                spans[-1] += len(text)
            else:
                spans += [size, size + len(text)]
        held.append(text)
        size += len(text)
    yield "".join(held), spans


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from batch.itertuples(index=False, name=None)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, text and spans (starts and ends of the loss mask) of every conversation.

    `turns` has conv_id, turn, role and text; the result is a table in the shared folder.
    """
    compile_template(template)  # errors show here

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
            messages = ({"role": r[1], "text": r[2]} for r in rows)
            for part, (text, spans) in enumerate(_parts(render({"messages": messages}))):
                yield pd.DataFrame({"conv_id": [conv_id], "part": [part], "text": [text], "spans": [spans]})

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in run(batches):
            held.append(frame)
            size += len(frame["text"].iloc[0])
            if size > 4 << 20:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    tune(turns.sparkSession)
    string = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").cast("string").alias("conv"), F.col("turn").cast("long"), string("role").alias("role"), string("text").alias("text"))
    dealt = rows.repartition(parallelism(turns), "conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    out = dealt.select(F.coalesce("conv", F.lit("")).alias("conv"), "role", "text").mapInPandas(gathered, "conv_id string, part int, text string, spans array<long>")
    return materialize(out, "formatted")


class _Reader:
    """Digests of one conversation, read back part by part."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def read(self, text: str, spans: list[int]) -> None:
        at = 0
        while at < len(text):
            m = _TURN.match(text, at)
            if not m:
                raise ValueError("formatted text isn't made of turns")
            role, said = unescape(m[1]), unescape(m[2])
            self.turns.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
            self.n_turns += 1
            at = m.end()
        for begin, end in zip(spans[::2], spans[1::2], strict=True):
            said = unescape(text[begin:end])
            self.loss.update(said.encode("utf-8", "replace"))
            self.loss_chars += len(said)
        self.chars += len(text)


def read_back(formatted: DataFrame) -> DataFrame:
    """n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, out = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"], []
        for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
            reader = _Reader()
            for _, text, spans in rows:
                reader.read(text, list(spans))
            out.append((conv_id, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))
            if len(out) >= 4096:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    tune(formatted.sparkSession)
    dealt = formatted.repartition(parallelism(formatted), "conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "text", "spans")
    out = dealt.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumn("conv_id", F.expr("cast(nullif(conv_id, '') as long)"))
