"""The template language of package recipes: text with {{ expressions }}, {% statements %} and {# comments #}, rendered by a small evaluator that knows data only, no Python objects.

Names, attributes and results that aren't there are silent: they print as nothing, are false, have no items, and can be called. Functions of the build system (compiler, pin_compatible ...) are such names. Statements: set (also of several names, and as a
block), if / elif / else, for / else with ``loop``, raw. Expressions: or, and, not, comparisons, in, tests by ``is``, ``~``, arithmetic, filters, attributes, items and slices, calls of text, list and dictionary methods that change nothing,
conditional expressions, and literals.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import islice


class TemplateError(ValueError):
    """The text isn't a template, or asks for what templates can't do."""


class Missing:
    """What isn't there."""

    def __bool__(self):
        return False

    def __str__(self):
        return ""

    def __iter__(self):
        return iter(())

    def __len__(self):
        return 0

    def __eq__(self, other):
        return isinstance(other, Missing)

    def __hash__(self):
        return 0


MISSING = Missing()
MAX_ITEMS = 100_000  # of a range, a repeated text or a loop's output: a template can't ask for more
_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?\s*raw\s*-?%\}.*?\{%-?\s*endraw\s*-?%\}|\{%[-+]?.*?[-+]?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<number>\d+(?:\.\d+)?)|(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|<=|>=|//|\*\*|[-+*/%~|.,:()\[\]{}<>=]))""", re.S)
#: Methods of texts, lists and dictionaries that a template may call.
METHODS = {str: {"lower", "upper", "strip", "lstrip", "rstrip", "replace", "split", "rsplit", "startswith", "endswith", "join", "title", "capitalize", "format", "find", "count", "zfill", "splitlines"}, list: {"index", "count"}, dict: {"get", "items", "keys", "values"}}
_ORDER = {"or": 1, "and": 2, "in": 4, "==": 4, "!=": 4, "<": 4, ">": 4, "<=": 4, ">=": 4, "~": 5, "+": 6, "-": 6, "*": 7, "/": 7, "//": 7, "%": 7}


def tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class Parser:
    """An expression as nested tuples, operators by their order."""

    def __init__(self, source: str):
        self.rest, self.at = tokens(source), 0

    def peek(self, *marks: str) -> str | None:
        word = self.rest[self.at][1] if self.at < len(self.rest) and self.rest[self.at][0] != "text" else None
        return word if not marks or word in marks else None

    def take(self, *marks: str) -> str:
        word = self.peek(*marks)
        if word is None:
            raise TemplateError(f"expected {' or '.join(marks)} in {self.rest!r}")
        self.at += 1
        return word

    def whole(self):
        out = self.listed()
        if self.at < len(self.rest):
            raise TemplateError(f"more than an expression: {self.rest!r}")
        return out

    def listed(self):
        """An expression, or several with commas: a list."""
        first = self.expression()
        if not self.peek(","):
            return first
        items = [first]
        while self.peek(","):
            self.at += 1
            if self.at < len(self.rest) and not self.peek(")"):
                items.append(self.expression())
        return "list", items

    def expression(self):
        value = self.binary(0)
        if self.peek("if"):
            self.at += 1
            test = self.binary(0)
            other = ("value", MISSING)
            if self.peek("else"):
                self.at += 1
                other = self.expression()
            return "choose", test, value, other
        return value

    def binary(self, least: int):
        if self.peek("not") and least <= 3:
            self.at += 1
            left = ("not", self.binary(3))
        else:
            left = self.unary()
        while True:
            word = self.peek()
            if word == "is" and least <= 4:
                self.at += 1
                negated = bool(self.peek("not")) and bool(self.take("not"))
                name = self.take()
                argument = self.unary() if self.at < len(self.rest) and (self.rest[self.at][0] in ("number", "text") or self.peek("(")) else ("value", None)
                left = ("test", name, left, argument)
                left = ("not", left) if negated else left
                continue
            if word == "not" and self.at + 1 < len(self.rest) and self.rest[self.at + 1][1] == "in" and least <= 4:
                self.at += 2
                left = ("not", ("binary", "in", left, self.binary(5)))
                continue
            if word not in _ORDER or _ORDER[word] < least:
                return left
            self.at += 1
            left = ("binary", word, left, self.binary(_ORDER[word] + 1))

    def unary(self):
        if self.peek("-", "+"):
            sign = self.take("-", "+")
            return "sign", sign, self.unary()
        value = self.postfix(self.primary())
        if self.peek("**"):
            raise TemplateError("powers aren't for templates")
        return value

    def primary(self):
        if self.at >= len(self.rest):
            raise TemplateError("an expression ends too early")
        kind, word = self.rest[self.at]
        self.at += 1
        if kind == "number":
            return "value", float(word) if "." in word else int(word)
        if kind == "text":
            text = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1] if m[1] in "\\'\"" else m[0]), word[1:-1], flags=re.S)
            while self.at < len(self.rest) and self.rest[self.at][0] == "text":  # neighbours are one
                text += self.primary()[1]
            return "value", text
        if kind == "name":
            constants = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
            return ("value", constants[word]) if word in constants else ("name", word)
        if word == "(":
            value = self.listed() if not self.peek(")") else ("list", [])
            self.take(")")
            return value
        if word == "[":
            return "list", self.until("]")
        if word == "{":
            pairs = []
            while not self.peek("}"):
                key = self.expression()
                self.take(":")
                pairs.append((key, self.expression()))
                if not self.peek("}"):
                    self.take(",")
            self.take("}")
            return "dict", pairs
        raise TemplateError(f"unexpected {word!r}")

    def until(self, end: str) -> list:
        items = []
        while not self.peek(end):
            items.append(self.expression())
            if not self.peek(end):
                self.take(",")
        self.take(end)
        return items

    def arguments(self) -> tuple[list, dict]:
        plain, named = [], {}
        while not self.peek(")"):
            if self.rest[self.at][0] == "name" and self.at + 1 < len(self.rest) and self.rest[self.at + 1] == ("mark", "="):
                name = self.take()
                self.take("=")
                named[name] = self.expression()
            else:
                plain.append(self.expression())
            if not self.peek(")"):
                self.take(",")
        self.take(")")
        return plain, named

    def postfix(self, value):
        while True:
            if self.peek("."):
                self.at += 1
                value = ("item", value, ("value", int(w) if (w := self.take()).isdigit() else w))
            elif self.peek("["):
                self.at += 1
                parts, colons = [None], 0
                while not self.peek("]"):
                    if self.peek(":"):
                        self.at += 1
                        colons += 1
                        parts.append(None)
                    else:
                        parts[-1] = self.expression()
                self.take("]")
                value = ("slice", value, parts) if colons else ("item", value, parts[0] or ("value", MISSING))
            elif self.peek("("):
                self.at += 1
                value = ("call", value, *self.arguments())
            elif self.peek("|"):
                self.at += 1
                name = self.take()
                arguments = ([], {})
                if self.peek("("):
                    self.at += 1
                    arguments = self.arguments()
                value = ("filter", name, value, *arguments)
            else:
                return value


def text_of(value) -> str:
    return str(value)


def _join(value, by="", attribute=None):
    return text_of(by).join(text_of(_item(v, attribute) if attribute else v) for v in value)


def _item(value, key):
    try:
        if isinstance(value, dict):
            return value.get(key, MISSING)
        if isinstance(value, (str, list)) and isinstance(key, int) and not isinstance(key, bool):
            return value[key]
    except (IndexError, TypeError):
        pass
    return MISSING


#: Filters by name; the first argument is the value.
FILTERS = {
    "lower": lambda v: text_of(v).lower(), "upper": lambda v: text_of(v).upper(), "title": lambda v: text_of(v).title(), "capitalize": lambda v: text_of(v).capitalize(), "trim": lambda v: text_of(v).strip(),
    "replace": lambda v, a, b, count=-1: text_of(v).replace(text_of(a), text_of(b), count), "join": _join, "string": text_of, "int": lambda v, default=0: _number(int, v, default), "float": lambda v, default=0.0: _number(float, v, default),
    "default": lambda v, other="", boolean=False: other if isinstance(v, Missing) or boolean and not v else v, "length": len, "first": lambda v: next(iter(v), MISSING), "last": lambda v: next(reversed(list(v)), MISSING),
    "list": list, "sort": lambda v, reverse=False: sorted(v, reverse=reverse), "unique": lambda v: list(dict.fromkeys(v)), "reverse": lambda v: v[::-1] if isinstance(v, str) else list(v)[::-1], "abs": abs, "round": lambda v, n=0: round(v, n) if n else float(round(v)),
    "select": lambda v: [x for x in v if x], "reject": lambda v: [x for x in v if not x], "map": lambda v, name=None, attribute=None: [_item(x, attribute) if attribute else FILTERS[name](x) for x in v], "sum": sum, "min": min, "max": max,
    "split": lambda v, by=None: text_of(v).split(by), "tojson": lambda v: __import__("json").dumps(v), "items": lambda v: [list(x) for x in v.items()] if isinstance(v, dict) else [],
}
FILTERS |= {"d": FILTERS["default"], "count": len}
TESTS = {
    "defined": lambda v, _: not isinstance(v, Missing), "undefined": lambda v, _: isinstance(v, Missing), "none": lambda v, _: v is None, "string": lambda v, _: isinstance(v, str), "number": lambda v, _: isinstance(v, (int, float)) and not isinstance(v, bool),
    "sequence": lambda v, _: isinstance(v, (str, list)), "mapping": lambda v, _: isinstance(v, dict), "iterable": lambda v, _: isinstance(v, (str, list, dict, Missing)), "even": lambda v, _: v % 2 == 0, "odd": lambda v, _: v % 2 == 1,
    "divisibleby": lambda v, n: v % n == 0, "equalto": lambda v, n: v == n, "lower": lambda v, _: text_of(v).islower(), "upper": lambda v, _: text_of(v).isupper(), "true": lambda v, _: v is True, "false": lambda v, _: v is False,
}


def _number(kind, value, default):
    try:
        return kind(float(value)) if kind is int and isinstance(value, str) and "." in value else kind(value)
    except (TypeError, ValueError):
        return default


def _range(*bounds):
    out = list(islice(range(*bounds), MAX_ITEMS + 1))
    if len(out) > MAX_ITEMS:
        raise TemplateError("a range is too long")
    return out


def evaluate(node, env: dict):
    kind = node[0]
    if kind == "value":
        return node[1]
    if kind == "name":
        return env.get(node[1], MISSING)
    if kind == "list":
        return [evaluate(x, env) for x in node[1]]
    if kind == "dict":
        return {evaluate(k, env): evaluate(v, env) for k, v in node[1]}
    if kind == "choose":
        return evaluate(node[2] if evaluate(node[1], env) else node[3], env)
    if kind == "not":
        return not evaluate(node[1], env)
    if kind == "sign":
        value = evaluate(node[2], env)
        return MISSING if isinstance(value, Missing) else -value if node[1] == "-" else +value
    if kind == "item":
        return _item(evaluate(node[1], env), evaluate(node[2], env))
    if kind == "slice":
        value = evaluate(node[1], env)
        bounds = [None if p is None else evaluate(p, env) for p in node[2]]
        return value[slice(*bounds)] if isinstance(value, (str, list)) else MISSING
    if kind == "test":
        if node[1] not in TESTS:
            raise TemplateError(f"no test {node[1]}")
        return TESTS[node[1]](evaluate(node[2], env), evaluate(node[3], env))
    if kind == "filter":
        if node[1] not in FILTERS:
            raise TemplateError(f"no filter {node[1]}")
        return FILTERS[node[1]](evaluate(node[2], env), *(evaluate(x, env) for x in node[3]), **{k: evaluate(v, env) for k, v in node[4].items()})
    if kind == "call":
        plain, named = [evaluate(x, env) for x in node[2]], {k: evaluate(v, env) for k, v in node[3].items()}
        if node[1][0] == "item":
            value, name = evaluate(node[1][1], env), evaluate(node[1][2], env)
            if isinstance(name, str) and name in METHODS.get(type(value), ()):
                if name == "format":
                    return _format(value, plain, named)
                out = getattr(value, name)(*plain, **named)
                return [list(x) if isinstance(x, tuple) else x for x in out] if isinstance(value, dict) and name != "get" else out
        elif node[1] == ("name", "range"):
            return _range(*plain)
        elif node[1] == ("name", "dict"):
            return named
        return MISSING
    _, word, left, right = node
    a = evaluate(left, env)
    if word == "and":
        return evaluate(right, env) if a else a
    if word == "or":
        return a if a else evaluate(right, env)
    return _binary(word, a, evaluate(right, env))


def _format(template: str, plain: list, named: dict) -> str:
    """Places by number or name only: no attributes."""
    count = iter(range(len(plain)))

    def place(m):
        if m[0] in ("{{", "}}"):
            return m[0][0]
        key = m[1] or str(next(count, len(plain)))
        value = plain[int(key)] if key.isdigit() and int(key) < len(plain) else named.get(key, MISSING)
        return text_of(value)

    return re.sub(r"\{\{|\}\}|\{(\w*)\}", place, template)


def _binary(word: str, a, b):
    if word == "~":
        return text_of(a) + text_of(b)
    if word == "==":
        return a == b
    if word == "!=":
        return a != b
    if word == "in":
        return not isinstance(b, Missing) and (text_of(a) in b if isinstance(b, str) else a in b)
    if isinstance(a, Missing) or isinstance(b, Missing):
        return MISSING if word in "+-*//%" else False
    if word == "*" and not (isinstance(a, (int, float)) and isinstance(b, (int, float))) and (len(a if isinstance(a, (str, list)) else b) * (b if isinstance(b, int) else a) > MAX_ITEMS):
        raise TemplateError("a repetition is too long")
    try:
        return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b, "//": lambda: a // b, "%": lambda: a % b, "<": lambda: a < b, ">": lambda: a > b, "<=": lambda: a <= b, ">=": lambda: a >= b}[word]()
    except (TypeError, ZeroDivisionError) as e:
        raise TemplateError(str(e)) from e


_HEAD = re.compile(r"^(\w+)\s*(.*)$", re.S)


@lru_cache(maxsize=64)
def parse(template: str) -> list:
    """The statements of a template: ("text", t), ("print", e), ("set", names, e), ("if", [(test, body)]), ("for", names, e, test, body, other)."""
    parts, out = [p for p in _TAG.split(template) if p], []
    stack: list[tuple[str, list, list]] = [("", [], out)]
    strip_next = False
    for i, part in enumerate(parts):
        body = stack[-1][2]
        if raw := re.fullmatch(r"\{%-?\s*raw\s*-?%\}(.*?)\{%-?\s*endraw\s*-?%\}", part, re.S):
            body.append(("text", raw[1]))
            continue
        if not (part.startswith(("{{", "{%", "{#")) and part.endswith(("}}", "%}", "#}"))):
            text = part.lstrip() if strip_next else part
            if i + 1 < len(parts) and re.match(r"\{[{%#]-", parts[i + 1]):
                text = text.rstrip()
            body.append(("text", text))
            strip_next = False
            continue
        strip_next = part[-3] == "-"
        inner = part[2:-2].strip("-+").strip()
        if part.startswith("{#"):
            continue
        if part.startswith("{{"):
            body.append(("print", Parser(inner).whole()))
            continue
        m = _HEAD.match(inner)
        word, rest = (m[1], m[2]) if m else ("", "")
        if word == "set":
            names, eq, value = rest.partition("=")
            names = [n.strip() for n in names.split(",")]
            if eq:
                body.append(("set", names, Parser(value).whole()))
            else:
                node = ("block", names, [])
                body.append(node)
                stack.append(("set", [node], node[2]))
        elif word == "if":
            node = ("if", [(Parser(rest).whole(), [])])
            body.append(node)
            stack.append(("if", node[1], node[1][0][1]))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            branch = (Parser(rest).whole() if word == "elif" else ("value", True), [])
            stack[-1][1].append(branch)
            stack[-1] = ("if", stack[-1][1], branch[1])
        elif word == "for":
            names, found, source = re.split(r"\s+(in)\s+", rest, maxsplit=1) if re.search(r"\s+in\s+", rest) else ("", "", "")
            if not found:
                raise TemplateError(f"no loop: {rest}")
            parser = Parser(source)
            items = parser.binary(0)
            test = None
            if parser.peek("if"):
                parser.at += 1
                test = parser.expression()
            if parser.at < len(parser.rest):
                raise TemplateError(f"no loop: {rest}")
            node = ("for", [n.strip() for n in names.strip("() ").split(",")], items, test, [], [])
            body.append(node)
            stack.append(("for", [node], node[4]))
        elif word == "else" and stack[-1][0] == "for":
            stack[-1] = ("for", stack[-1][1], stack[-1][1][0][5])
        elif word in ("endif", "endfor", "endset"):
            if stack.pop()[0] != word[3:]:
                raise TemplateError(f"{word} without its beginning")
        else:
            raise TemplateError(f"no statement {word}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} without its end")
    return out


def _run(body: list, env: dict, out: list[str]) -> None:
    for node in body:
        if node[0] == "text":
            out.append(node[1])
        elif node[0] == "print":
            out.append(text_of(evaluate(node[1], env)))
        elif node[0] == "set":
            value = evaluate(node[2], env)
            env |= {node[1][0]: value} if len(node[1]) == 1 else dict(zip(node[1], value, strict=False))
        elif node[0] == "block":
            inner: list[str] = []
            _run(node[2], env, inner)
            env[node[1][0]] = "".join(inner)
        elif node[0] == "if":
            _run(next((b for test, b in node[1] if evaluate(test, env)), []), env, out)
        else:
            names, found = node[1], evaluate(node[2], env)
            bind = lambda v, names=names: {names[0]: v} if len(names) == 1 else dict(zip(names, v, strict=False))
            items = [v for v in found if node[3] is None or evaluate(node[3], env | bind(v))]
            for i, v in enumerate(items):
                loop = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(items) - 1, "length": len(items), "revindex": len(items) - i}
                _run(node[4], env | bind(v) | {"loop": loop}, out)  # what a loop sets ends with the turn
                if len(out) > MAX_ITEMS * 10:
                    raise TemplateError("a loop is too long")
            if not items:
                _run(node[5], env, out)


def render(template: str, **names) -> str:
    """The text that a template makes of the given names."""
    out: list[str] = []
    try:
        _run(parse(template), dict(names), out)
    except (TypeError, IndexError, AttributeError, KeyError, RecursionError) as e:
        raise TemplateError(f"{type(e).__name__}: {e}") from e
    return "".join(out)
