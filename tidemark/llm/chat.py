"""Chat formatting: a template compiler (parser, constant folding, closures) that renders conversations
with generation markers, and the way back from formatted text to turns.

The language knows text, ``{{ expression }}``, ``{% for x in list %}``, ``{% if %} {% elif %} {% else %}``,
``{% set x = expression %}`` and ``{% generation %}``. Expressions have literals, names, ``a.key``,
``a[index]``, ``== != < <= > >= in and or not + ~`` and filters. It is a sandbox: a dot reads a key
of a dictionary and nothing else, nothing can be called, and there is no loop but over lists that are given."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: marks of turns; no text may hold one, so ``escape`` alters them there
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>"]

DEFAULT = """\
{%- for m in messages -%}
{%- if m.role == 'user' -%}[INST]{{ m.text | escape }}[/INST]
{%- elif m.role == 'assistant' -%}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>
{%- elif m.role == 'system' -%}<<SYS>>{{ m.text | escape }}<</SYS>>
{%- else -%}<<ROLE>>{{ m.role | escape }}<<TEXT>>{{ m.text | escape }}<</ROLE>>
{%- endif -%}
{%- endfor -%}"""

_MARKS = re.compile("|".join(f"{re.escape(c[0])}(\\\\*){re.escape(c[1:])}" for c in CONTROL))


def escape(text: str) -> str:
    """A control string, with any number of backslashes behind its first character, gets one more there."""
    return _MARKS.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _MARKS.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(), "length": lambda x: len(x) if isinstance(x, (str, list, dict)) else 0,
}


def _text(x) -> str:
    return "" if x is None else "true" if x is True else "false" if x is False else str(x)


class TemplateError(ValueError):
    """The template cannot be parsed."""


# --- parser: syntax trees of tuples ---------------------------------------------------

_TAGS = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\})", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)"
                    r"|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _pieces(source: str) -> list[tuple[str, str]]:
    """(text | echo | tag, content), with blanks cut where a tag has a dash."""
    out, cut = [], False
    for i, part in enumerate(_TAGS.split(source)):
        if i % 2 == 0:
            out.append(("text", part.lstrip() if cut else part))
            continue
        if part[2] == "-":
            out[-1] = ("text", out[-1][1].rstrip())
        cut = part[-3] == "-"
        out.append(("echo" if part[1] == "{" else "tag", part[2:-2].strip("-").strip()))
    return [p for p in out if p != ("text", "")]


class _Expression:
    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("op", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing in {self.source!r}")

    def whole(self) -> tuple:
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"cannot read {self.peek()[1]!r} in {self.source!r}")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negation()
        while self.take("and"):
            node = ("and", node, self.negation())
        return node

    def negation(self):
        return ("not", self.negation()) if self.take("not") else self.compared()

    def compared(self):
        node = self.sum()
        while op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
            node = ("binary", op, node, self.sum())
        return node

    def sum(self):
        node = self.filtered()
        while op := self.take("+", "~"):
            node = ("binary", op, node, self.filtered())
        return node

    def filtered(self):
        node = self.member()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def member(self):
        node = self.atom()
        while True:
            if self.take("."):
                kind, name = self.peek()
                if kind != "name":
                    raise TemplateError(f"no key after the dot in {self.source!r}")
                self.at += 1
                node = ("key", node, ("const", name))
            elif self.take("["):
                node = ("key", node, self.either())
                self.need("]")
            else:
                return node

    def atom(self):
        kind, value = self.peek()
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "num":
            return ("const", int(value))
        if kind == "name" and value not in ("in", "and", "or", "not"):
            known = {"true": True, "false": False, "none": None}
            return ("const", known[value]) if value in known else ("name", value)
        if value == "(":
            node = self.either()
            self.need(")")
            return node
        raise TemplateError(f"cannot read {value!r} in {self.source!r}")


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template."""
    pieces = _pieces(source)
    at = 0

    def block(*ends: str) -> tuple[list[tuple], str]:
        nonlocal at
        out: list[tuple] = []
        while at < len(pieces):
            kind, content = pieces[at]
            at += 1
            if kind == "text":
                out.append(("text", content))
                continue
            if kind == "echo":
                out.append(("echo", _Expression(content).whole()))
                continue
            word, _, rest = content.partition(" ")
            if word in ends:
                return out, content
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {content!r}")
                body, _ = block("endfor")
                out.append(("for", m[1], _Expression(m[2]).whole(), body))
            elif word == "if":
                branches, test = [], _Expression(rest).whole()
                while True:
                    body, end = block("elif", "else", "endif")
                    branches.append((test, body))
                    if end == "endif":
                        break
                    test = ("const", True) if end == "else" else _Expression(end.partition(" ")[2]).whole()
                out.append(("if", branches))
            elif word == "set":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)\s*(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {content!r}")
                out.append(("set", m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                out.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"no tag {content!r} here")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return out, ""

    return block()[0]


# --- constant folding --------------------------------------------------------------------

def _binary(op: str, a, b):
    if op == "==":
        return a == b
    if op == "!=":
        return a != b
    if op == "~":
        return _text(a) + _text(b)
    if op == "in":
        return isinstance(b, str) and isinstance(a, str) and a in b or isinstance(b, (list, dict)) and a in b
    if op == "+":
        return a + b if type(a) is type(b) and isinstance(a, (int, str)) else _text(a) + _text(b)
    if type(a) is not type(b) or not isinstance(a, (int, str)):
        return False  # what cannot be ordered is not less, nor greater
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]


def _key(of, key):
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, str)) and isinstance(key, int) and not isinstance(key, bool) and -len(of) <= key < len(of):
        return of[key]
    return None


def fold(node: tuple) -> tuple:
    """An expression with its constant parts computed."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "not":
        x = fold(node[1])
        return ("const", not x[1]) if x[0] == "const" else ("not", x)
    if kind in ("and", "or"):
        a, b = fold(node[1]), fold(node[2])
        if a[0] == "const":
            return b if bool(a[1]) == (kind == "and") else a
        return (kind, a, b)
    if kind == "filter":
        x = fold(node[2])
        return ("const", FILTERS[node[1]](x[1])) if x[0] == "const" else ("filter", node[1], x)
    if kind == "binary":
        a, b = fold(node[2]), fold(node[3])
        return ("const", _binary(node[1], a[1], b[1])) if a[0] == b[0] == "const" else ("binary", node[1], a, b)
    a, b = fold(node[1]), fold(node[2])
    return ("const", _key(a[1], b[1])) if a[0] == b[0] == "const" else ("key", a, b)


def fold_block(block: list[tuple]) -> list[tuple]:
    """A block with constants folded, dead branches gone and neighbouring texts joined."""
    out: list[tuple] = []
    for node in block:
        kind = node[0]
        if kind == "echo":
            x = fold(node[1])
            new = [("text", _text(x[1]))] if x[0] == "const" else [("echo", x)]
        elif kind == "if":
            branches = []
            for test, body in node[1]:
                test = fold(test)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold_block(body)))
                if test[0] == "const":
                    break
            new = branches[0][1] if branches and branches[0][0][0] == "const" else [("if", branches)] if branches else []
        elif kind == "for":
            new = [("for", node[1], fold(node[2]), fold_block(node[3]))]
        elif kind == "set":
            new = [("set", node[1], fold(node[2]))]
        elif kind == "generation":
            new = [("generation", fold_block(node[1]))]
        else:
            new = [node]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


# --- closures ------------------------------------------------------------------------------

def _value(node: tuple) -> Callable:
    kind = node[0]
    if kind == "const":
        constant = node[1]
        return lambda env: constant
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "not":
        x = _value(node[1])
        return lambda env: not x(env)
    if kind == "filter":
        x, use = _value(node[2]), FILTERS[node[1]]
        return lambda env: use(x(env))
    if kind == "binary":
        op, a, b = node[1], _value(node[2]), _value(node[3])
        return (lambda env: a(env) == b(env)) if op == "==" else lambda env: _binary(op, a(env), b(env))
    a, b = _value(node[1]), _value(node[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env: _key(a(env), b(env))


class _Out:
    """Formatted text as it grows, and its generated spans."""

    __slots__ = ("parts", "size", "spans")

    def __init__(self):
        self.parts, self.size, self.spans = [], 0, []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _run(block: list[tuple]) -> Callable:
    steps = [_step(n) for n in block]
    if len(steps) == 1:
        return steps[0]

    def run(env, out):
        for s in steps:
            s(env, out)
    return run


def _step(node: tuple) -> Callable:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.add(text)
    if kind == "echo":
        x = _value(node[1])
        return lambda env, out: out.add(_text(x(env)))
    if kind == "set":
        name, x = node[1], _value(node[2])
        return lambda env, out: env.__setitem__(name, x(env))
    if kind == "generation":
        body = _run(node[1])

        def generation(env, out):
            start = out.size
            body(env, out)
            out.spans.append((start, out.size))
        return generation
    if kind == "if":
        branches = [(_value(t), _run(b)) for t, b in node[1]]

        def choose(env, out):
            for test, body in branches:
                if test(env):
                    return body(env, out)
        return choose
    name, items, body = node[1], _value(node[2]), _run(node[3])

    def loop(env, out):
        given = items(env)
        given = given if isinstance(given, list) else []
        for i, x in enumerate(given):  # names set inside stay inside
            body({**env, name: x, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": i + 1 == len(given)}}, out)
    return loop


def _names(node) -> set[str]:
    if isinstance(node, tuple) and len(node) == 2 and node[0] == "name":
        return {node[1]}
    return {n for x in node for n in _names(x)} if isinstance(node, (tuple, list)) else set()


class Template:
    """A compiled template. ``render(messages)`` gives (text, generated spans in code points).

    ``per_message`` renders one message alone, where the template is a loop over messages whose body
    knows only its message: its results laid end to end are the text of the conversation, however long. Else it is None."""

    def __init__(self, source: str):
        self.tree = fold_block(parse(source))
        self._run = _run(self.tree)
        self.per_message = None
        if len(self.tree) == 1 and self.tree[0][0] == "for" and self.tree[0][2] == ("name", "messages"):
            _, name, _, body = self.tree[0]
            inner = {n[1] for n in body if n[0] == "set"}
            if _names(body) <= {name} | inner:
                each = _run(body)

                def per_message(message: dict):
                    out = _Out()
                    each({name: message}, out)
                    return "".join(out.parts), out.spans
                self.per_message = per_message

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        self._run({"messages": messages}, out)
        return "".join(out.parts), out.spans


_TURN = re.compile(r"\[INST\](?P<user>.*?)\[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>"
                   r"|<<ROLE>>(?P<role>.*?)<<TEXT>>(?P<text>.*?)<</ROLE>>", re.S)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text that the default template made."""
    out = []
    for m in _TURN.finditer(formatted):
        role = m.lastgroup
        out.append((unescape(m["role"]), unescape(m["text"])) if role == "text" else (role, unescape(m[role])))
    return out


# --- Spark ---------------------------------------------------------------------------------

def _turns(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text("role").alias("role"), text("text").alias("text"))


def format_turns(conversations: DataFrame, template: str = DEFAULT) -> DataFrame:
    """``conv_id, turn, role, part, loss`` for every row of ``conversations(conv_id, turn, role, text)``: the row's part of
    the formatted conversation and the spans of it, in code points, that are under the loss mask. Parts in order
    of turn, then role, then part are the conversation. The template must be a loop whose body
    knows only its message, as the default one; so nothing is gathered and a conversation may have any length.
    Null role and text are empty; a null conv_id is a conversation, a null turn comes first; repeated rows are turns of
    their own; empty tables give empty results; other columns are not read."""
    if Template(template).per_message is None:
        raise TemplateError("the template needs whole conversations; use render")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        each = Template(template).per_message
        for batch in batches:
            made = [each({"role": r, "text": t}) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            loss = [[{"start": a, "end": b} for a, b in s] for _, s in made]
            yield pa.record_batch([*batch.columns[:3], pa.array([m[0] for m in made], pa.string()), pa.array(loss, span)],
                                  ["conv_id", "turn", "role", "part", "loss"])

    return _turns(conversations).mapInArrow(run, "conv_id long, turn long, role string, part string, "
                                                 "loss array<struct<start:int,end:int>>")


def render(conversations: DataFrame, template: str) -> DataFrame:
    """``conv_id, formatted, loss``: each conversation as one text, by any template. Turns are ordered by turn, role
    and text; a conversation must fit a row. Nulls, ties and empty tables as in ``format_turns``."""
    grouped = (_turns(conversations).groupBy("conv_id")
               .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        made = Template(template)
        for batch in batches:
            out = [made.render([{"role": t["role"], "text": t["text"]} for t in ts]) for ts in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([t for t, _ in out], pa.string()),
                                   pa.array([[{"start": a, "end": b} for a, b in s] for _, s in out], span)],
                                  ["conv_id", "formatted", "loss"])

    return grouped.mapInArrow(run, "conv_id long, formatted string, loss array<struct<start:int,end:int>>")


def digest_turns(parts: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation of
    ``format_turns``, read from its formatted parts alone. A task reads its conversations in order and holds running
    digests, never a conversation."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    # role and text are in the part, so its order stands for that of the text among equal turns and roles
    ordered = parts.select("conv_id", "turn", "role", "part", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "part")

    def run(batches):
        now, rows, begun = None, [], False
        n = chars = size = 0
        turns = loss = None

        def closed():
            return (now, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            for conv, part, spans in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if not begun or conv != now:
                    if begun:
                        rows.append(closed())
                    now, begun, n, chars, size = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in turns_of(part):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                for s in spans:
                    text = unescape(part[s["start"]:s["end"]])
                    chars += len(text)
                    loss.update(text.encode())
                size += len(part)
            if rows:
                yield made(rows)
                rows = []
        if begun:
            yield made([closed()])

    def made(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in schema.split(", ")])

    return ordered.mapInArrow(run, schema)


def round_trip(conversations: DataFrame) -> DataFrame:
    """Formats ``conversations`` into the session's shared folder and reads the digests back from there."""
    spark = conversations.sparkSession
    to = scratch_path(spark, "chat")
    format_turns(conversations).write.parquet(to)
    return digest_turns(spark.read.parquet(to))
