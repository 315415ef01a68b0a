"""Chat formatting: a small sandboxed template language, compiled to Python closures.

    {{ expression }}   {% for m in messages %} ... {% endfor %}   {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}      (the text inside is under the loss mask)

Expressions: string and integer literals, true, false, none, names, ``m.field``, ``loop.first``, ``loop.index0``, ``~`` (joins texts), ``==``, ``!=``, ``in``, ``and``, ``or``,
``not``, parentheses, and filters after ``|``: upper, lower, trim, escape. Nothing else can be reached: no calls, attributes of Python objects or indexing.
Source -> tokens -> syntax tree -> constants folded -> closures. Closures stream: they take an iterator of messages and give pieces one at a time, so a
conversation of any length is rendered in the memory of one turn.

Edge cases: null roles and texts are empty; turns with one number go by role and text; repeated rows are turns each; rows without a conversation id are conversations of their own; an empty table gives an empty one (the probe's conversation only, where it is added).

``escape`` puts ``\\`` after the first character of each control string of a text and doubles the text's own ``\\``; ``unescape`` drops one ``\\`` of each pair or lone one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
TEMPLATE = (
    "{{ '<s>' }}{% for m in messages %}[ROLE]{{ m.role | escape }}[/ROLE]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ '</' ~ 's>' }}"
    "{% else %}[INST]{{ m.text | escape }}[/INST]{% endif %}{% endfor %}"
)
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", lambda m: m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"upper": str.upper, "lower": str.lower, "trim": str.strip, "escape": escape}


class TemplateError(ValueError):
    pass


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[~|().]))")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    while source[at:].strip():
        if not (m := _TOKEN.match(source, at)):
            raise TemplateError(f"unexpected {source[at:].strip()[:10]!r}")
        if m[1]:
            out.append(("const", re.sub(r"\\(.)", lambda x: _ESCAPES.get(x[1], x[0]), m[1][1:-1], flags=re.S)))
        elif m[2]:
            out.append(("const", int(m[2])))
        elif m[3] in ("true", "false", "none"):
            out.append(("const", {"true": True, "false": False, "none": None}[m[3]]))
        else:
            out.append(("name", m[3]) if m[3] and m[3] not in ("and", "or", "not", "in") else ("op", m[3] or m[4]))
        at = m.end()
    return [*out, ("end", None)]


class _Expression:
    """Recursive descent; each method returns a node: ("const", v), ("var", name), ("get", name, field), ("not", a), (operator, a, b), ("filter", name, a)."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def take(self, *values: object) -> object:
        kind, value = self.tokens[self.at]
        if kind == "op" and value in values:
            self.at += 1
            return value
        return None

    def parse(self) -> tuple:
        node = self.either()
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
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
        while op := self.take("==", "!=", "in"):
            node = (op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            kind, name = self.tokens[self.at]
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        kind, value = self.tokens[self.at]
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        if kind not in ("const", "name"):
            raise TemplateError(f"unexpected {value!r}")
        self.at += 1
        if kind == "const":
            return ("const", value)
        if self.take("."):
            kind, field = self.tokens[self.at]
            if kind != "name" or field.startswith("_"):
                raise TemplateError(f"no field {field!r}")
            self.at += 1
            return ("get", value, field)
        return ("var", value)


def _text(x: object) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)


_APPLY: dict[str, Callable] = {
    "~": lambda a, b: _text(a) + _text(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: _text(a) in _text(b),
    "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}


def parse(source: str) -> list[tuple]:
    """The syntax tree: ("text", s), ("print", e), ("for", name, body), ("if", [(e, body), ...]), ("generation", body)."""
    root: list[tuple] = []
    stack: list[tuple[str, list, object]] = [("root", root, None)]
    at = 0
    for m in _TAG.finditer(source):
        body = stack[-1][1]
        if source[at : m.start()]:
            body.append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            body.append(("print", _Expression(m[1]).parse()))
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for":
            if not (f := re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+messages\s*", rest)):
                raise TemplateError(f"for {rest}")
            if any(kind == "for" for kind, _, _ in stack):
                raise TemplateError("messages can be read once only")
            node = ("for", f[1], [])
            body.append(node)
            stack.append(("for", node[2], None))
        elif word == "if":
            node = ("if", [(_Expression(rest).parse(), [])])
            body.append(node)
            stack.append(("if", node[1][0][1], node))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            node = stack.pop()[2]
            node[1].append((_Expression(rest).parse() if word == "elif" else ("const", True), []))
            stack.append(("if", node[1][-1][1], node))
        elif word == "generation":
            node = ("generation", [])
            body.append(node)
            stack.append(("generation", node[1], None))
        elif word.startswith("end") and stack[-1][0] == word[3:]:
            stack.pop()
        else:
            raise TemplateError(f"unexpected {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} isn't closed")
    if source[at:]:
        root.append(("text", source[at:]))
    return root


def fold_expression(e: tuple) -> tuple:
    if e[0] in ("const", "var", "get"):
        return e
    if e[0] == "filter":
        inner = fold_expression(e[2])
        return ("const", FILTERS[e[1]](_text(inner[1]))) if inner[0] == "const" else ("filter", e[1], inner)
    parts = [fold_expression(x) for x in e[1:]]
    if e[0] == "not":
        return ("const", not parts[0][1]) if parts[0][0] == "const" else ("not", *parts)
    return ("const", _APPLY[e[0]](parts[0][1], parts[1][1])) if all(p[0] == "const" for p in parts) else (e[0], *parts)


def fold(nodes: list[tuple]) -> list[tuple]:
    """Constant expressions become texts, neighbouring texts one, and decided branches vanish."""
    out: list[tuple] = []

    def put(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "print":
            e = fold_expression(node[1])
            put(("text", _text(e[1])) if e[0] == "const" else ("print", e))
        elif node[0] == "if":
            left = []
            for test, body in node[1]:
                test = fold_expression(test)
                if test[0] != "const":
                    left.append((test, fold(body)))
                elif test[1]:
                    left.append((test, fold(body)))
                    break
            if left and left[0][0][0] == "const":
                for x in left[0][1]:
                    put(x)
            elif left:
                put(("if", left))
        elif node[0] == "for":
            put(("for", node[1], fold(node[2])))
        elif node[0] == "generation":
            put(("generation", fold(node[1])))
        else:
            put(node)
    return out


def _closure(e: tuple) -> Callable[[dict], object]:
    if e[0] == "const":
        return lambda env, v=e[1]: v
    if e[0] == "var":
        return lambda env, name=e[1]: env.get(name)
    if e[0] == "get":
        return lambda env, name=e[1], field=e[2]: (env.get(name) or {}).get(field)
    if e[0] == "filter":
        return lambda env, f=FILTERS[e[1]], a=_closure(e[2]): f(_text(a(env)))
    if e[0] == "not":
        return lambda env, a=_closure(e[1]): not a(env)
    a, b = _closure(e[1]), _closure(e[2])
    if e[0] == "and":
        return lambda env: a(env) and b(env)
    if e[0] == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_APPLY[e[0]]: f(a(env), b(env))


def _block(nodes: list[tuple], loss: bool) -> Callable[[dict, Iterator[dict]], Iterator[tuple[str, bool]]]:
    steps: list[Callable] = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda env, messages, s=node[1]: ((s, loss),))
        elif node[0] == "print":
            steps.append(lambda env, messages, f=_closure(node[1]): ((_text(f(env)), loss),))
        elif node[0] == "generation":
            steps.append(_block(node[1], True))
        elif node[0] == "if":
            tests = [(_closure(test), _block(body, loss)) for test, body in node[1]]

            def branch(env, messages, tests=tests):
                for test, body in tests:
                    if test(env):
                        return body(env, messages)
                return ()

            steps.append(branch)
        else:

            def loop(env, messages, name=node[1], body=_block(node[2], loss)):
                for i, message in enumerate(messages):
                    yield from body(env | {name: message, "loop": {"first": i == 0, "index0": i}}, messages)

            steps.append(loop)

    def run(env, messages):
        for step in steps:
            yield from step(env, messages)

    return run


def compile_template(source: str) -> Callable[[Iterator[dict]], Iterator[tuple[str, bool]]]:
    """A renderer: an iterator of messages (role, text) -> (piece, whether it is under the loss mask), in order."""
    run = _block(fold(parse(source)), False)
    return lambda messages: run({}, iter(messages))


PIECES = "conv_id long, seq long, formatted string, loss_spans array<struct<start:long,stop:long>>, ends boolean"


def format_rows(frames: Iterator[pd.DataFrame], template: str) -> Iterator[pd.DataFrame]:
    """Sorted rows (conv_id, role, text) -> formatted pieces of about 256 kB with the spans under the loss mask, in characters of the piece."""
    render = compile_template(template)
    rows = (r for f in frames for r in zip(f["is_null"].tolist(), f["conv_id"].tolist(), f["role"].tolist(), f["text"].tolist(), strict=True))
    ready: list[tuple] = []
    row = next(rows, None)
    while row is not None:
        conv, held = row[:2], [row]

        def messages():
            while held[0] is not None and held[0][:2] == conv:
                message = {"role": held[0][2], "text": held[0][3]}
                held[0] = next(rows, None)
                yield message
                if conv[0]:  # a row without an id stands alone
                    return

        parts, spans, size, seq = [], [], 0, 0
        for piece, loss in render(messages()):
            if size + len(piece) > 1 << 18 and parts:
                ready.append((None if conv[0] else conv[1], seq, "".join(parts), spans, False))
                parts, spans, size, seq = [], [], 0, seq + 1
                yield _frame(ready)
                ready = []
            if loss:
                spans.append((size, size + len(piece)))
            parts.append(piece)
            size += len(piece)
        if held[0] is row or not conv[0]:
            for _ in messages():  # a template that doesn't loop leaves rows
                pass
        ready.append((None if conv[0] else conv[1], seq, "".join(parts), spans, True))
        row = held[0]
        if len(ready) >= 500:
            yield _frame(ready)
            ready = []
    if ready:
        yield _frame(ready)


def _frame(ready: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(ready, columns=["conv_id", "seq", "formatted", "loss_spans", "ends"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    out["loss_spans"] = [[{"start": a, "stop": b} for a, b in x] for x in out["loss_spans"]]
    return out


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Renders each conversation (conv_id, turn, role, text; rows by turn, ties by role and text, nulls first) in pieces, in order of conv_id and seq.

    Null roles and texts are empty; each row without an id is a conversation of its own, since nothing says that such rows belong together, and they are dealt by their content. Rows are dealt by
    conv_id and sorted by Spark (which spills), and a conversation streams through the renderer, so a conversation with a large part of all rows needs time, not memory.
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = c.repartition("conv_id", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))).sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = dealt.select(F.col("conv_id").isNull().alias("is_null"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"), "role", "text")
    return rows.mapInPandas(lambda frames: format_rows(frames, template), PIECES)


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Reader:
    """Reads the default template's output back, piece after piece."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.rest = ""
        self.carry = ""
        self.begun = False

    def feed(self, piece: str, spans: list) -> None:
        self.chars += len(piece)
        for s in spans:
            # a span holds whole escaped texts, so each can be unescaped by itself
            text = unescape(piece[s["start"] : s["stop"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.rest += piece
        if not self.begun:
            if not self.rest.startswith("<s>"):
                raise ValueError("not formatted by the default template")
            self.rest, self.begun = self.rest[3:], True
        at = 0
        while m := self.turn(at):
            role, text, at = m
            self.n += 1
            self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
        self.rest = self.rest[at:]

    def turn(self, at: int) -> tuple[str, str, int] | None:
        s = self.rest
        if not s.startswith("[ROLE]", at) or (b := s.find("[/ROLE]", at)) < 0:
            return None
        role, b = s[at + 6 : b], b + 7
        if s.startswith("[INST]", b):
            return (role, s[b + 6 : c], c + 7) if (c := s.find("[/INST]", b)) >= 0 else None
        if "[INST]".startswith(s[b : b + 6]) and len(s) < b + 6:
            return None
        return (role, s[b:c], c + 4) if (c := s.find("</s>", b)) >= 0 else None


def read_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    reader, out = Reader(), []
    for f in frames:
        for conv, piece, spans, ends in zip(f["conv_id"].astype("Int64").tolist(), f["formatted"].tolist(), f["loss_spans"].tolist(), f["ends"].tolist(), strict=True):
            reader.feed(piece, spans)
            if ends:
                if reader.rest:
                    raise ValueError(f"conversation {conv} can't be read back")
                out.append((None if conv is pd.NA else conv, reader.n, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))
                reader = Reader()
        if len(out) >= 1000:
            yield _back(out)
            out = []
    if out:
        yield _back(out)


def _back(out: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    f["conv_id"] = f["conv_id"].astype("Int64")
    return f


def read_back(pieces: DataFrame) -> DataFrame:
    """What each formatted conversation says: turns, digest of the turns, and the text under the loss mask. Pieces must come as format_conversations gives them."""
    return pieces.mapInPandas(read_rows, READ_BACK)


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table and conversation -1: a user and an assistant row that hold control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
