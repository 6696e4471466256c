"""Structure of Java code that no expression can follow: one scan of a file gives all its classes and methods.

A method is a name with a parenthesis behind it and, before it, white space and a
word (a type or modifier, not ``new``), a closed generic or an array bracket.  Its
body is opened by the first brace behind the name, unless a semicolon comes first.
It begins behind the last semicolon or brace before the name; comments there belong
to it, whatever signs they hold.  Of several of one name the first counts, with a
body or not.  Braces and semicolons of literals and comments are no such signs.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_HIDDEN = re.compile(r""""(?:[^"\\]++|\\(?:[\s\S]|\Z))*+(?:"|\Z)|'(?:[^'\\]++|\\(?:[\s\S]|\Z))*+(?:'|\Z)|//[^\n]*|/\*[^*]*+(?:\*(?!/)[^*]*+)*+(?:\*/|\Z)""")
#: What the scan stops at: a sign, a parenthesis, or a class with its name.  It begins with one set of characters, so what lies between is passed over fast.
_STOPS = re.compile(r"[{};(ceir](?:(?<=[{};(])|(?:(?<=c)lass(?<![\w$.]class)|(?<=i)nterface(?<![\w$.]interface)|(?<=e)num(?<![\w$.]enum)|(?<=r)ecord(?<![\w$.]record))\s+([\w$]+))")
#: Kinds of classes by their first letter.
_KINDS = {"c": "class", "i": "interface", "e": "enum", "r": "record"}
_WORDS = re.compile(r"[\w$.]+")


class Method(NamedTuple):
    """A declaration: where its name stands, where it begins and ends, the classes around it, how deep it lies, and its modifiers and type."""

    name: str
    at: int
    start: int
    end: int | None
    inside: str
    depth: int
    head: tuple[str, ...]


class Type(NamedTuple):
    name: str
    kind: str
    parent: str | None
    inside: str
    at: int


def _blank(found: re.Match) -> str:
    part = found.group()
    return "\n".join([" " * len(line) for line in part.split("\n")]) if part[0] == "/" else " " * len(part)


def masked_code(code: str) -> str:
    """Code of the same length with blanks for literals and comments; line ends in comments stay."""
    return _HIDDEN.sub(_blank, code)


class Stop(NamedTuple):
    """``what``: a sign, "(" for a name and its parenthesis, or the kind of a class; from ``at`` to ``end``."""

    at: int
    end: int
    what: str
    name: str | None


def _unspaced(text: str, low: int, end: int) -> int:
    """Where the part of ``text`` from ``low`` to ``end`` ends, white space behind it left off."""
    width = 16
    while end > low:
        part = text[max(low, end - width) : end]
        kept = len(part.rstrip())
        if kept:
            return end - len(part) + kept
        end, width = end - len(part), width * 4
    return end


def _in_word(c: str) -> bool:
    return c.isalnum() or c in "_$"


def _stops(text: str):
    """Signs, classes with their names, and names with a parenthesis behind them, in order; each takes up where the last ended."""
    last = 0
    for m in _STOPS.finditer(text):
        what, at = m[0], m.start()
        if what == "(":
            start = end = _unspaced(text, last, at)
            while start > last and _in_word(text[start - 1]):
                start -= 1
            if start < end:
                yield Stop(start, at + 1, what, text[start:end])
        elif m[1]:
            yield Stop(at, m.end(), _KINDS[what[0]], m[1])
        else:
            yield Stop(at, at + 1, what, None)
        last = m.end()


def _declared(seen: str, at: int) -> bool:
    """Whether what stands before the name at ``at`` is a type or modifier."""
    end = _unspaced(seen, 0, at)
    if end == at or not end:
        return False
    if seen[end - 1] in ">]":
        return True
    return _in_word(seen[end - 1]) and not (seen.endswith("new", 0, end) and (end == 3 or not _in_word(seen[end - 4])))


def _parent(header: str) -> str | None:
    """The class behind ``extends`` in what follows a class's name, generics left out."""
    plain, depth = [], 0
    for c in header:
        depth += c == "<"
        plain.append(c if not depth and c not in "<>" else " ")
        depth -= c == ">" and depth > 0
    words = _WORDS.findall("".join(plain))
    return words[words.index("extends") + 1] if "extends" in words[:-1] else None


def outline(code: str, masked: str | None = None, search_masked: bool = True) -> tuple[list[Type], list[Method]]:
    """All classes and declared methods of a file, in order, from one scan; ``end`` is None without a body that is closed.

    search_masked: whether names are looked for in masked code, rather than in the
    code as it is; signs are always those of masked code.
    """
    masked = masked_code(code) if masked is None else masked
    stops = _stops(masked)
    if not search_masked:
        signs = [m for m in stops if m.what != "("]
        stops = sorted([*signs, *(m for m in _stops(code) if m.what == "(")], key=lambda m: m.at)
    seen = masked if search_masked else code
    types: list[Type] = []
    methods: list[Method] = []
    stack: list[tuple[str | None, list[int]]] = []
    path: list[str] = []
    named, waiting, begin = None, [], 0
    # Words of masked code behind the last sign, where the last of them begins, and from where to look on: a word may go on.
    words, tail, onward = [], -1, 0
    for m in stops:
        if m.what == "(":
            if _declared(seen, m.at):
                waiting.append(len(methods))
                for word in _WORDS.finditer(masked, onward, m.at):
                    if word.start() == tail:
                        words.pop()
                    words.append(word[0])
                    tail = word.start()
                onward = tail if words and tail + len(words[-1]) == m.at else m.at
                methods.append(Method(m.name, m.at, begin, None, "$".join(path), len(stack), tuple(words)))
            continue
        if m.name:
            named = m
            continue
        if m.what == "{":
            if named:
                types.append(Type(named.name, named.what, _parent(masked[named.end : m.at]), "$".join(path), named.at))
                path.append(named.name)
            stack.append((named and named.name, waiting))
        elif m.what == "}" and stack:
            name, opened = stack.pop()
            if name:
                path.pop()
            for i in opened:
                methods[i] = methods[i]._replace(end=m.end)
        if m.what != "}":
            named, waiting = None, []
        begin = onward = m.end
        words, tail = [], -1
    if named:  # a class whose brace is missing
        types.append(Type(named.name, named.what, _parent(masked[named.end :]), "$".join(path), named.at))
    return types, methods


def body(code: str, method: Method | None) -> str | None:
    return None if method is None or method.end is None else code[method.start : method.end].strip()


def method_body(code: str, name: str, search_masked: bool = False) -> str | None:
    """The first method of that name, from its modifiers to its last brace; null if there is none or it has no closed body."""
    if name not in code:
        return None
    return body(code, next((m for m in outline(code, None, search_masked)[1] if m.name == name), None))


def mask(code: Column) -> Column:
    """``masked_code`` of a column; null stays."""

    @F.arrow_udf("string")
    def run(codes: pa.Array) -> pa.Array:
        return pa.array([None if c is None else masked_code(c) for c in codes.to_pylist()], pa.string())

    return run(code)


def method(code: Column, name: Column, search_masked: bool = False) -> Column:
    """``method_body`` of two columns; null where one is."""

    @F.arrow_udf("string")
    def run(codes: pa.Array, names: pa.Array) -> pa.Array:
        both = zip(codes.to_pylist(), names.to_pylist())
        return pa.array([None if c is None or n is None else method_body(c, n, search_masked) for c, n in both], pa.string())

    return run(code, name)


#: One scan's result: ``first`` marks the first method of a name, ``first_open`` the first with a body that other classes may call.
OUTLINE = "struct<masked:string,types:array<struct<name:string,kind:string,parent:string,inside:string>>,methods:array<struct<name:string,inside:string,depth:int,at:int,first:boolean,first_open:boolean,constructor:boolean,body:string>>>"


def _row(code: str, search_masked: bool) -> dict:
    masked = masked_code(code)
    types, methods = outline(code, masked, search_masked)
    names: set[str] = set()
    open_names: set[str] = set()
    rows = []
    for m in methods:
        is_open = ("public" in m.head or "protected" in m.head) and m.end is not None and m.name not in open_names
        made = m.name == m.inside.rpartition("$")[2]
        rows.append({"name": m.name, "inside": m.inside, "depth": m.depth, "at": m.at, "first": m.name not in names, "first_open": is_open, "constructor": made, "body": body(code, m)})
        names.add(m.name)
        if is_open:
            open_names.add(m.name)
    return {"masked": masked, "types": [t._asdict() for t in types], "methods": rows}


def outlined(code: Column, search_masked: bool = False) -> Column:
    """``OUTLINE`` of a column: masked code, classes and methods; null stays."""
    type_ = pa.struct([("name", pa.string()), ("kind", pa.string()), ("parent", pa.string()), ("inside", pa.string())])
    method_ = pa.struct([("name", pa.string()), ("inside", pa.string()), ("depth", pa.int32()), ("at", pa.int32()), ("first", pa.bool_()), ("first_open", pa.bool_()), ("constructor", pa.bool_()), ("body", pa.string())])
    whole = pa.struct([("masked", pa.string()), ("types", pa.list_(type_)), ("methods", pa.list_(method_))])

    @F.arrow_udf(OUTLINE)
    def run(codes: pa.Array) -> pa.Array:
        return pa.array([None if c is None else _row(c, search_masked) for c in codes.to_pylist()], whole)

    return run(code)
