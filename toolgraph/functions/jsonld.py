"""One JSON-LD document to triples: contexts, nested and blank nodes, lists, languages and datatypes. A helper of operators/triples.py, called for batches of documents inside tasks."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from decimal import Decimal
from urllib.parse import urljoin

RDF, XSD = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2001/XMLSchema#"
BLANK = "urn:blank:"
#: The keywords of the format that this reader knows.
KEYWORDS = {"@id", "@type", "@value", "@language", "@list", "@set", "@graph", "@context", "@reverse", "@vocab", "@base", "@container", "@index", "@none"}


class Context:
    """What names mean: term -> definition, and @vocab, @base and @language."""

    def __init__(self, terms: dict | None = None, vocab: str | None = None, base: str = "", language: str | None = None, known: dict | None = None):
        self.terms, self.vocab, self.base, self.language, self.known = terms or {}, vocab, base, language, known or {}

    def extended(self, local, seen: frozenset = frozenset()) -> Context:
        """This context with a local one on top: an object, a list of them, null (all forgotten) or the address of a known one."""
        if local is None:
            return Context(known=self.known)
        if isinstance(local, list):
            out = self
            for part in local:
                out = out.extended(part, seen)
            return out
        if isinstance(local, str):
            return self if local in seen else self.extended(self.known.get(local.rstrip("/"), {}), seen | {local})
        if not isinstance(local, dict):
            return self
        if "@context" in local:
            return self.extended(local["@context"], seen)
        out = Context(dict(self.terms), self.vocab, self.base, self.language, self.known)
        if "@vocab" in local:
            out.vocab = self.iri(local["@vocab"]) if local["@vocab"] else local["@vocab"]
        if isinstance(local.get("@base"), str):
            out.base = urljoin(self.base, local["@base"])
        if "@language" in local:
            out.language = local["@language"]
        for term, definition in local.items():
            if not term.startswith("@"):
                out.terms[term] = {"@id": definition} if isinstance(definition, str) else dict(definition) if isinstance(definition, dict) else {"@id": None}
        for term, definition in local.items():  # names may refer to terms that come later
            if term in out.terms and not term.startswith("@"):
                d = out.terms[term]
                named = d.get("@reverse") or d.get("@id", term if ":" in term else None)
                d["iri"] = named if named in KEYWORDS else out.iri(named, frozenset({term})) if named else out._plain(term) if "@id" not in d else None
        return out

    def _plain(self, name: str) -> str | None:
        return self.vocab + name if self.vocab else None

    def iri(self, name: str, busy: frozenset = frozenset()) -> str | None:
        """The IRI of a key or type: a term, prefix:rest, an IRI, or a name of the vocabulary; None for a name without meaning."""
        d = self.terms.get(name)
        if d is not None and name not in busy:
            return d["iri"] if "iri" in d else self.iri(d.get("@id") or name, busy | {name})
        if name in KEYWORDS:
            return name
        prefix, colon, rest = name.partition(":")
        if colon:
            if prefix == "_" or rest.startswith("//"):
                return name
            base = self.iri(prefix, busy | {name}) if prefix in self.terms and prefix not in busy else None
            return base + rest if base else name
        return self._plain(name)

    def link(self, name: str) -> str:
        """The IRI of an @id: prefix:rest, an IRI, or an address relative to the base."""
        prefix, colon, rest = name.partition(":")
        if colon and prefix in self.terms and not rest.startswith("//"):
            return (self.iri(prefix) or prefix + ":") + rest
        return name if colon or not self.base else urljoin(self.base, name)


class Reader:
    """Collects (s, p, o, o_kind, lang, datatype) of a document."""

    def __init__(self, document_key: str):
        self.key, self.out = document_key, []

    def blank(self, content) -> str:
        return BLANK + hashlib.sha256(json.dumps(content, sort_keys=True, ensure_ascii=False).encode("utf-8", "replace")).hexdigest()[:32]

    def name(self, iri: str) -> str:
        """Labels of blank nodes hold within their document only."""
        return self.blank([self.key, iri]) if iri.startswith("_:") else iri

    def node(self, node: dict, context: Context) -> str:
        """Adds a node's triples; its name is its @id, or made of its content, so equal nodes without one are one."""
        if "@context" in node:
            context = context.extended(node["@context"])
        facts, back, subject = [], [], None
        for key, value in node.items():
            if key == "@context":
                continue
            p = context.iri(key)
            if p == "@id":
                subject = self.name(context.link(value)) if isinstance(value, str) else None
            elif p == "@type":
                facts += [(RDF + "type", self.name(t), "iri", None, None) for t in (context.iri(v) or context.link(v) for v in _list(value) if isinstance(v, str))]
            elif p == "@graph":
                self.top(value, context)
            elif p == "@reverse" and isinstance(value, dict):
                back += [(context.iri(k), o) for k, v in value.items() for o in self.objects(v, context, {}) if context.iri(k)]
            elif p and not p.startswith("@") and ":" in p:
                d = context.terms.get(key, {})
                if "@reverse" in d:
                    back += [(p, o) for o in self.objects(value, context, d)]
                else:
                    facts += [(p, *o) for o in self.objects(value, context, d)]
        if subject is None:
            if not facts and not back:
                return ""
            subject = self.blank(sorted(facts, key=repr))
        self.out += [(subject, *f) for f in facts] + [(o[0], p, subject, "iri", None, None) for p, o in back if o[1] == "iri"]
        return subject

    def objects(self, value, context: Context, d: dict) -> list[tuple]:
        """(o, o_kind, lang, datatype) of a value under a term's definition."""
        kind, container = d.get("@type"), d.get("@container")
        language = d["@language"] if "@language" in d else context.language
        if "@list" in _list(container) and not (isinstance(value, dict) and "@list" in value):
            value = {"@list": _list(value)}
        if "@language" in _list(container) and isinstance(value, dict):
            return [(str(v), "literal", k if k != "@none" else None, None) for k, vs in value.items() for v in _list(vs) if v is not None]
        if "@index" in _list(container) and isinstance(value, dict):
            value = [v for vs in value.values() for v in _list(vs)]
        out = []
        for v in _list(value):
            if v is None:
                continue
            if isinstance(v, dict):
                named = {context.iri(k): x for k, x in v.items()} if not set(v) <= KEYWORDS else v
                if "@set" in named:
                    out += self.objects(named["@set"], context, {k: x for k, x in d.items() if k != "@container"})
                elif "@list" in named:
                    out.append((self.chain(_list(named["@list"]), context, d), "iri", None, None))
                elif "@value" in named:
                    if named["@value"] is not None:
                        type_ = named.get("@type")
                        text, own = _literal(named["@value"])
                        out.append((text, "literal", named.get("@language"), context.iri(type_) if isinstance(type_, str) else own))
                else:
                    o = self.node(v, context)
                    if o:
                        out.append((o, "iri", None, None))
            elif isinstance(v, str) and kind in ("@id", "@vocab"):
                iri = (context.iri(v) if kind == "@vocab" else None) or context.link(v)
                out.append((self.name(iri), "iri", None, None))
            else:
                text, own = _literal(v)
                typed = context.iri(kind) if isinstance(kind, str) and not kind.startswith("@") else own
                out.append((text, "literal", language if typed is None and isinstance(v, str) else None, typed))
        return out

    def chain(self, values: list, context: Context, d: dict) -> str:
        """A list, as a chain of nodes named by what follows."""
        inner = {k: x for k, x in d.items() if k != "@container"}
        rest = RDF + "nil"
        for o in reversed([o for v in values for o in ([(self.chain(v, context, d), "iri", None, None)] if isinstance(v, list) else self.objects(v, context, inner))]):
            cell = self.blank([o, rest])
            self.out += [(cell, RDF + "first", *o), (cell, RDF + "rest", rest, "iri", None, None)]
            rest = cell
        return rest

    def top(self, value, context: Context) -> None:
        for node in _list(value):
            if isinstance(node, dict):
                self.node(node, context)
            elif isinstance(node, list):
                self.top(node, context)


def _list(value) -> list:
    return value if isinstance(value, list) else [value]


def _literal(value) -> tuple[str, str | None]:
    """The text of a plain value, and the datatype of one that isn't a text."""
    if isinstance(value, bool):
        return ("true" if value else "false"), XSD + "boolean"
    if isinstance(value, int):
        return str(value), XSD + "integer"
    if isinstance(value, Decimal):
        return str(value), XSD + "double"
    return (value if isinstance(value, str) else json.dumps(value, sort_keys=True, ensure_ascii=False, default=str)), None


def triples_of(text: str, prefixes: dict[str, str], vocabulary: str | None, contexts: dict) -> list[tuple]:
    """(s, p, o, o_kind, lang, datatype) of one document; nothing if it isn't JSON or nested too deeply to be read."""
    try:
        document = json.loads(text, parse_float=Decimal)
        reader = Reader(hashlib.sha256(text.encode("utf-8", "replace")).hexdigest())
        reader.top(document, Context({p: {"@id": b, "iri": b} for p, b in prefixes.items()}, vocabulary, known={k.rstrip("/"): v for k, v in contexts.items()}))
    except (ValueError, RecursionError):
        return []
    return list(dict.fromkeys(reader.out))


_TOKEN = re.compile(
    r"""\s+|\#[^\n]*|(?P<iri><[^>]*>)|(?P<text>\"\"\"(?:[^\\]|\\.)*?\"\"\"|"(?:[^"\\\n]|\\.)*")|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<number>[+-]?(?:\d+\.\d+|\.\d+|\d+)(?:[eE][+-]?\d+)?)|(?P<mark>[;,.\[\]()])|(?P<name>(?:[\w%:-]|\\.|\.(?=[\w%:\\-]))+)""",
    re.S,
)
_ESCAPE = re.compile(r'\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|([tbnrf"\'\\]))')
_CONTROL = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}


def _unescape(text: str) -> str:
    return text if "\\" not in text else _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _CONTROL.get(m[3], m[3]), text)


class _Turtle:
    """Reads a Turtle document token by token, with one token ahead. Methods, not functions that hold one another: such circles keep a document's tokens until Python looks for circles, which it seldom does where texts are read."""

    def __init__(self, text: str):
        self.tokens = ((m.lastgroup, m[0]) for m in _TOKEN.finditer(text) if m.lastgroup)
        self.ahead = next(self.tokens, None)
        self.reader = Reader(hashlib.sha256(text.encode("utf-8", "replace")).hexdigest())
        self.prefixes, self.base = {}, ""

    def take(self) -> tuple[str, str]:
        token = self.ahead
        if token is None:
            raise ValueError("a Turtle document ends within a statement")
        self.ahead = next(self.tokens, None)
        return token

    def resource(self, kind: str, token: str) -> str:
        if kind == "iri":
            return urljoin(self.base, _unescape(token[1:-1])) if self.base else _unescape(token[1:-1])
        prefix, _, local = token.partition(":")
        if prefix == "_":
            return self.reader.name(token)
        return self.prefixes[prefix] + (re.sub(r"\\(.)", r"\1", local) if "\\" in local else local)

    def term(self) -> tuple:
        kind, token = self.take()
        if kind == "text":
            body = _unescape(token[3:-3] if token.startswith('"""') else token[1:-1])
            follows = self.ahead[0] if self.ahead else None
            if follows == "lang":
                return body, "literal", self.take()[1][1:], None
            if follows == "type":
                self.take()
                return body, "literal", None, self.resource(*self.take())
            return body, "literal", None, None
        if kind == "number":
            return token, "literal", None, XSD + ("double" if "e" in token.lower() else "decimal" if "." in token else "integer")
        if token in ("true", "false"):
            return token, "literal", None, XSD + "boolean"
        if token == "[":
            facts = list(self.predicates("]"))
            s = self.reader.blank(sorted(facts, key=repr))
            self.reader.out.extend((s, *f) for f in facts)
            return s, "iri", None, None
        if token == "(":
            items = []
            while not self.ahead or self.ahead[1] != ")":
                items.append(self.term())
            self.take()
            rest = RDF + "nil"
            for o in reversed(items):
                cell = self.reader.blank([o, rest])
                self.reader.out.extend([(cell, RDF + "first", *o), (cell, RDF + "rest", rest, "iri", None, None)])
                rest = cell
            return rest, "iri", None, None
        return self.resource(kind, token), "iri", None, None

    def predicates(self, end: str) -> Iterator[tuple]:
        while (found := self.take())[1] != end:
            if found[1] == ";":
                continue
            p = RDF + "type" if found[1] == "a" else self.resource(*found)
            yield p, *self.term()
            while self.ahead and self.ahead[1] == ",":
                self.take()
                yield p, *self.term()

    def triples(self) -> Iterator[tuple]:
        while self.ahead:
            word = self.ahead[1].lower()
            if word in ("@prefix", "prefix", "@base", "base"):
                self.take()
                if word.endswith("prefix"):
                    name = self.take()[1].rstrip(":")
                    self.prefixes[name] = self.resource(*self.take())
                else:
                    self.base = self.resource(*self.take())
                if word.startswith("@") and self.ahead:
                    self.take()
                continue
            s = self.term()[0]
            for f in self.predicates("."):
                yield s, *f
                yield from self.reader.out
                self.reader.out.clear()
            yield from self.reader.out  # a subject may be a node or a list without facts of its own
            self.reader.out.clear()


def turtle_triples(text: str) -> Iterator[tuple]:
    """(s, p, o, o_kind, lang, datatype) of a Turtle document, with repeats, one after the other as they are read: prefixes, ``a``, lists of objects and predicates, typed and tagged literals, numbers, booleans, blank nodes and collections."""
    return _Turtle(text).triples()
