"""A compiler for a small, sandboxed chat-template language.

    {{ expression }}                          the value, as text
    {% for m in messages %} .. {% endfor %}   loop.first, loop.last, loop.index
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = expression %}
    {% generation %} .. {% endgeneration %}   what stands inside is marked

Expressions have strings, integers, true / false / none, names, ``a.key`` and ``a['key']`` (keys of
dictionaries only, never attributes), ``==  !=  and  or  not  +  ~``, and the filters given to the
compiler (``value | name``). There are no calls, no attributes and no other way out.

``parse`` gives a syntax tree of tuples, ``fold`` evaluates what is constant (and drops dead
branches), ``compile_template`` turns the tree into Python closures. A rendering is a stream of
(text, marked) pieces; loops read their messages one by one, so a conversation of any length
renders in the memory of one message.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
LEXEME = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[~+|.()\[\]]))")
ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    pass


# --- syntax tree ---------------------------------------------------------------

def _lex(s: str) -> list[tuple[str, object]]:
    out, at, s = [], 0, s.strip()
    while at < len(s):
        m = LEXEME.match(s, at)
        if not m:
            raise TemplateError(f"cannot read {s[at:]!r}")
        text, number, name, sign = m.groups()
        if text is not None:
            out.append(("const", re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.S)))
        elif number is not None:
            out.append(("const", int(number)))
        else:
            out.append(("name", name) if name else ("sign", sign))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the lexemes of one expression."""

    def __init__(self, text: str):
        self.left = _lex(text)

    def take(self, *want) -> bool:
        if self.left and self.left[0][1] in want and self.left[0][0] != "const":
            self.left.pop(0)
            return True
        return False

    def need(self, kind: str):
        if not self.left or self.left[0][0] != kind:
            raise TemplateError(f"{kind} expected")
        return self.left.pop(0)[1]

    def whole(self):
        e = self.any_of()
        if self.left:
            raise TemplateError(f"left over: {self.left}")
        return e

    def any_of(self):
        e = self.all_of()
        while self.take("or"):
            e = ("or", e, self.all_of())
        return e

    def all_of(self):
        e = self.negated()
        while self.take("and"):
            e = ("and", e, self.negated())
        return e

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        e = self.joined()
        while self.left and self.left[0] in (("sign", "=="), ("sign", "!=")):
            e = (self.left.pop(0)[1], e, self.joined())
        return e

    def joined(self):
        e = self.filtered()
        while self.left and self.left[0] in (("sign", "+"), ("sign", "~")):
            e = (self.left.pop(0)[1], e, self.filtered())
        return e

    def filtered(self):
        e = self.part()
        while self.take("|"):
            e = ("filter", self.need("name"), e)
        return e

    def part(self):
        if self.take("("):
            e = self.any_of()
            if not self.take(")"):
                raise TemplateError(") expected")
        elif self.left and self.left[0][0] == "const":
            e = self.left.pop(0)
        else:
            name = self.need("name")
            e = ("const", {"true": True, "false": False, "none": None}[name]) if name in ("true", "false", "none") else ("name", name)
        while True:
            if self.take("."):
                e = ("key", e, ("const", self.need("name")))
            elif self.take("["):
                e = ("key", e, self.any_of())
                if not self.take("]"):
                    raise TemplateError("] expected")
            else:
                return e


def parse(source: str):
    """The template as ("block", [nodes])."""
    pieces, at = [], 0
    for m in TAG.finditer(source):
        pieces += [("text", source[at:m.start()]), ("print", m[1]) if m[1] is not None else ("tag", m[2].strip())]
        at = m.end()
    pieces.append(("text", source[at:]))
    pieces = [p for p in pieces if p != ("text", "")]

    def block(*ends):
        nodes = []
        while pieces:
            kind, body = pieces.pop(0)
            if kind == "text":
                nodes.append(("text", body))
            elif kind == "print":
                nodes.append(("print", _Expression(body).whole()))
            else:
                word = body.split(None, 1)[0] if body else ""
                rest = body[len(word):].strip()
                if word in ends:
                    return ("block", nodes), word, rest
                if word == "for" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)):
                    nodes.append(("for", m[1], _Expression(m[2]).whole(), block("endfor")[0]))
                elif word == "if":
                    nodes.append(condition(rest))
                elif word == "set" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)):
                    nodes.append(("set", m[1], _Expression(m[2]).whole()))
                elif word == "generation":
                    nodes.append(("generation", block("endgeneration")[0]))
                else:
                    raise TemplateError(f"unknown tag {body!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} expected")
        return ("block", nodes), "", ""

    def condition(test):
        then, word, rest = block("elif", "else", "endif")
        other = ("block", [condition(rest)]) if word == "elif" else block("endif")[0] if word == "else" else ("block", [])
        return ("if", _Expression(test).whole(), then, other)

    return block()[0]


# --- constants -----------------------------------------------------------------

def _text(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: _text(a) + _text(b) if isinstance(a, str) or isinstance(b, str) else a + b,
    "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(node, filters: dict[str, Callable]):
    """``node`` with constant expressions evaluated, dead branches dropped and texts joined."""
    again = lambda n: fold(n, filters)
    kind = node[0]
    if kind in OPERATORS:
        a, b = again(node[1]), again(node[2])
        return ("const", OPERATORS[kind](a[1], b[1])) if a[0] == b[0] == "const" else (kind, a, b)
    if kind == "not":
        a = again(node[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"unknown filter {node[1]!r}")
        a = again(node[2])
        return ("const", filters[node[1]](a[1])) if a[0] == "const" else ("filter", node[1], a)
    if kind == "key":
        return ("key", again(node[1]), again(node[2]))
    if kind == "print":
        a = again(node[1])
        return ("text", _text(a[1])) if a[0] == "const" else ("print", a)
    if kind == "set":
        return ("set", node[1], again(node[2]))
    if kind == "for":
        return ("for", node[1], again(node[2]), again(node[3]))
    if kind == "generation":
        return ("generation", again(node[1]))
    if kind == "if":
        test = again(node[1])
        return again(node[2] if test[1] else node[3]) if test[0] == "const" else ("if", test, again(node[2]), again(node[3]))
    if kind == "block":
        nodes = []
        for n in map(again, node[1]):
            for x in n[1] if n[0] == "block" else [n]:
                if x[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + x[1])
                elif x != ("text", ""):
                    nodes.append(x)
        return ("block", nodes)
    return node


# --- closures ------------------------------------------------------------------

def _value(node, filters) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda scope, v=node[1]: v
    if kind == "name":
        return lambda scope, n=node[1]: scope.get(n)
    if kind == "key":
        of, key = _value(node[1], filters), _value(node[2], filters)

        def get(scope):
            v = of(scope)
            return v.get(key(scope)) if type(v) is dict else None
        return get
    if kind == "filter":
        f, a = filters[node[1]], _value(node[2], filters)
        return lambda scope: f(a(scope))
    if kind == "not":
        a = _value(node[1], filters)
        return lambda scope: not a(scope)
    a, b = _value(node[1], filters), _value(node[2], filters)
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    f = OPERATORS[kind]
    return lambda scope: f(a(scope), b(scope))


def _writer(node, marked: bool, filters) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    kind = node[0]
    if kind == "text":
        piece = (node[1], marked)
        return lambda scope: iter((piece,))
    if kind == "print":
        v = _value(node[1], filters)
        return lambda scope: iter(((_text(v(scope)), marked),))
    if kind == "generation":
        return _writer(node[1], True, filters)
    if kind == "set":
        v = _value(node[2], filters)

        def put(scope):
            scope[node[1]] = v(scope)
            return iter(())
        return put
    if kind == "if":
        test, then, other = _value(node[1], filters), _writer(node[2], marked, filters), _writer(node[3], marked, filters)
        return lambda scope: (then if test(scope) else other)(scope)
    if kind == "for":
        name, over, body = node[1], _value(node[2], filters), _writer(node[3], marked, filters)

        def loop(scope):
            left = iter(over(scope) or ())
            item, more, n = next(left, None), True, 0
            while more and not (n == 0 and item is None):
                after = next(left, None)
                n, more = n + 1, after is not None
                yield from body({**scope, name: item, "loop": {"first": n == 1, "last": not more, "index": n}})
                item = after
        return loop
    parts = [_writer(n, marked, filters) for n in node[1]]

    def block(scope):
        for p in parts:
            yield from p(scope)
    return block


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """A function from messages (dictionaries, read once) to the pieces of the rendering."""
    filters = filters or {}
    write = _writer(fold(parse(source), filters), False, filters)
    return lambda messages, **more: write({"messages": messages, **more})
