"""Regular expressions of the configuration, read into Java's form.

A configuration's dialect: named groups as ``(?P<name>...)``, ``[[:digit:]]`` for ASCII classes, ``\\pL`` and ``\\p{Greek}``, sets with
``&&``, ``\\z``; ``\\d \\w \\s \\b`` know all of Unicode, a dot is anything but a line feed and ``$`` is the end of the text. A pattern is read once, by
descent, into what Java has for it, with the least and the most characters of a match.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

INF = 1 << 30

# The ASCII classes, as ranges, and the names of scripts and properties that Java has as \p{Is...}.
POSIX = {
    "alnum": "0-9A-Za-z", "alpha": "A-Za-z", "ascii": r"\x00-\x7F", "blank": r"\x20\t", "cntrl": r"\x00-\x1F\x7F", "digit": "0-9", "graph": r"\x21-\x7E", "lower": "a-z",
    "print": r"\x20-\x7E", "punct": r"\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E", "space": r"\t-\r\x20", "upper": "A-Z", "word": "0-9A-Z_a-z", "xdigit": "0-9A-Fa-f",
}
NAMED = ("Alphabetic", "Arabic", "Armenian", "Cyrillic", "Devanagari", "Georgian", "Greek", "Han", "Hangul", "Hebrew", "Hiragana", "Katakana", "Latin", "Lowercase", "Thai", "Uppercase")
_PLAIN = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\x0b", "a": "\x07"}


class Unsupported(ValueError):
    """Not a pattern, or one that Java has no form for here."""


@dataclass(frozen=True)
class Java:
    """``source`` for Java; how many characters a match has; ``single``: whether it is one set of characters, repeated without end or not."""

    source: str
    least: int
    most: int
    groups: int
    single: str | None = None


@dataclass
class _Node:
    source: str
    least: int = 1
    most: int = 1
    atom: bool = True


def literal(ch: str) -> str:
    """A character that Java takes as itself, in a set or not."""
    return ch if ch in string.ascii_letters + string.digits or ch == "_" else f"\\x{{{ord(ch):X}}}"


class _Parser:
    def __init__(self, text: str) -> None:
        self.text, self.at, self.names, self.groups = text, 0, {}, 0
        self.flags = frozenset()
        self.unicode = False

    def peek(self, n: int = 1) -> str:
        return self.text[self.at : self.at + n]

    def take(self, expected: str | None = None) -> str:
        ch = self.peek()
        if not ch or expected is not None and ch != expected:
            raise Unsupported(self.text)
        self.at += 1
        return ch

    def until(self, end: str) -> str:
        to = self.text.find(end, self.at)
        if to < 0:
            raise Unsupported(self.text)
        out, self.at = self.text[self.at : to], to + len(end)
        return out

    def choice(self) -> _Node:
        flags, branches = self.flags, [self.sequence()]
        while self.peek() == "|":
            self.take()
            branches.append(self.sequence())
        self.flags = flags
        if len(branches) == 1:
            return branches[0]
        return _Node("|".join(b.source for b in branches), min(b.least for b in branches), max(b.most for b in branches), False)

    def sequence(self) -> _Node:
        parts: list[_Node] = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        if len(parts) == 1:
            return parts[0]
        return _Node("".join(p.source if p.atom else f"(?:{p.source})" for p in parts), sum(p.least for p in parts), min(INF, sum(p.most for p in parts)), False)

    def repeated(self, node: _Node) -> _Node:
        while self.peek() and self.peek() in "*+?{":
            ch = self.take()
            if ch == "{":
                low, _, high = (body := self.until("}")).partition(",")
                if not all(x == "" or x.isascii() and x.isdigit() for x in (low, high)) or not low and not high:
                    raise Unsupported(self.text)
                least, most = int(low or 0), int(high) if high else INF if "," in body else int(low)
                if most < least or least > 1000 or most != INF and most > 1000:
                    raise Unsupported(self.text)
                mark = f"{{{least}{'' if most == least else ',' if most == INF else f',{most}'}}}"
            else:
                least, most, mark = {"*": (0, INF, "*"), "+": (1, INF, "+"), "?": (0, 1, "?")}[ch]
            if self.peek() and self.peek() in "?+":
                mark += self.take()
            inner = node.source if node.atom else f"(?:{node.source})"
            node = _Node(f"{inner}{mark}", node.least * least, min(INF, node.most * most), False)
        return node

    def atom(self) -> _Node:
        ch = self.take()
        if ch == "(":
            return self.group()
        if ch == "[":
            return _Node(self.set())
        if ch == "\\":
            return self.escape()
        if ch == ".":
            return _Node(r"[\x00-\x{10FFFF}]" if "s" in self.flags else r"[^\n]")
        if ch == "^":
            return _Node(r"(?:(?<=\n)|\A)" if "m" in self.flags else r"\A", 0, 0)
        if ch == "$":
            return _Node(r"(?=\n|\z)" if "m" in self.flags else r"\z", 0, 0)
        if ch in "*+?{":
            raise Unsupported(self.text)
        return _Node(literal(ch))

    def group(self) -> _Node:
        kind = "("
        if self.peek() == "?":
            self.take()
            for mark in ("<=", "<!", "=", "!", ">", ":"):
                if self.peek(len(mark)) == mark:
                    self.at += len(mark)
                    kind = f"(?{mark}"
                    break
            else:
                if self.peek(2) == "P=":
                    self.at += 2
                    return self.back(self.until(")"))
                if self.peek(2) == "P<" or self.peek() == "<":
                    self.until("<")
                    name = self.until(">")
                    if not name or name in self.names or name[0].isdigit():
                        raise Unsupported(self.text)
                    self.names[name] = self.groups + 1
                else:
                    return self.switched()
        if kind == "(":
            self.groups += 1
        inner = self.choice()
        self.take(")")
        if kind in ("(?<=", "(?<!") and inner.most == INF:
            raise Unsupported(self.text)
        around = kind in ("(?<=", "(?<!", "(?=", "(?!")
        return _Node(f"{kind}{inner.source})", 0 if around else inner.least, 0 if around else inner.most)

    def switched(self) -> _Node:
        """``(?flags)`` to the end of the group, ``(?flags:...)`` for what it holds."""
        on, to = set(self.flags), True
        while (ch := self.take()) not in ":)":
            if ch == "-":
                to = False
            elif ch not in "imsu":
                raise Unsupported(self.text)
            elif to:
                on.add(ch)
            elif ch == "u":
                raise Unsupported(self.text)
            else:
                on.discard(ch)
        before, self.flags = self.flags, frozenset(on)
        mark = "(?iu:" if "i" in on else "(?-i:"
        if ch == ")":
            rest = self.sequence()
            while self.peek() == "|":
                self.take()
                more = self.sequence()
                rest = _Node(f"{rest.source}|{more.source}", min(rest.least, more.least), max(rest.most, more.most), False)
        else:
            rest = self.choice()
            self.take(")")
            self.flags = before
        return _Node(f"{mark}{rest.source})", rest.least, rest.most)

    def back(self, name: str) -> _Node:
        no = self.names.get(name, int(name) if name.isascii() and name.isdigit() else 0)
        if not 1 <= no <= self.groups:
            raise Unsupported(self.text)
        return _Node(f"(?:\\{no})", 0, INF)

    def escape(self) -> _Node:
        ch = self.peek()
        if ch in ("A", "z"):
            self.take()
            return _Node(f"\\{ch}", 0, 0)
        if ch in ("b", "B"):
            self.take()
            self.unicode = True
            return _Node(f"\\{ch}", 0, 0)
        if ch and ch in "123456789":
            self.take()
            if self.peek().isdigit():
                raise Unsupported(self.text)
            return self.back(ch)
        if ch == "k":
            self.take()
            self.take("<")
            return self.back(self.until(">"))
        kind, value = self.element()
        return _Node(value if kind == "set" else literal(value))

    def element(self) -> tuple[str, str]:
        """After a backslash: ("set", Java's form) or ("one", the character)."""
        ch = self.take()
        if ch in "dDwWsS":
            self.unicode = True
            return "set", f"\\{ch}"
        if ch in "pP":
            name = self.until("}") if self.peek() == "{" and self.take() else self.take()
            negated = name.startswith("^")
            name = name.removeprefix("^")
            if len(name) > 2 and name not in NAMED or not name.isascii() or not name.isalpha() or len(name) <= 2 and name[0] not in "LMNPSZC":
                raise Unsupported(self.text)
            return "set", f"\\{'pP'[(ch == 'P') != negated]}{{{name if len(name) <= 2 else f'Is{name}'}}}"
        if ch in "xuU":
            digits = self.until("}") if self.peek() == "{" and self.take() else self.peek({"x": 2, "u": 4, "U": 8}[ch])
            if self.text[self.at - 1] != "}":
                self.at += len(digits)
            if not digits or any(c not in string.hexdigits for c in digits) or int(digits, 16) > 0x10FFFF:
                raise Unsupported(self.text)
            return "one", chr(int(digits, 16))
        if ch in _PLAIN:
            return "one", _PLAIN[ch]
        if ch in string.ascii_letters + string.digits:
            raise Unsupported(self.text)
        return "one", ch

    def set(self) -> str:
        out, first = "[", True
        if self.peek() == "^":
            self.take()
            out += "^"
        while first or self.peek() != "]":
            if self.peek(2) == "[:":
                self.at += 2
                negated = self.peek() == "^" and bool(self.take())
                name = self.until(":]")
                if name not in POSIX:
                    raise Unsupported(self.text)
                out += f"[^{POSIX[name]}]" if negated else POSIX[name]
            elif self.peek() == "[":
                self.take()
                out += self.set()
            elif self.peek(2) == "&&":
                self.at += 2
                out += "&&"
            elif self.peek(2) in ("--", "~~"):
                raise Unsupported(self.text)
            else:
                kind, value = ("one", self.take()) if self.peek() != "\\" else (self.take(), self.element())[1]
                if kind == "set":
                    out += value
                elif self.peek() == "-" and self.peek(2) not in ("-]", "--"):
                    self.take()
                    kind, high = ("one", self.take()) if self.peek() != "\\" else (self.take(), self.element())[1]
                    if kind == "set" or high == "[" or value > high:
                        raise Unsupported(self.text)
                    out += f"{literal(value)}-{literal(high)}"
                else:
                    out += literal(value)
            first = False
        self.take("]")
        return out + "]"


def to_java(source: str) -> Java | None:
    """The pattern in Java's form; None if it is none, or needs what Java lacks."""
    parser = _Parser(source)
    try:
        node = parser.choice()
        if parser.peek():
            return None
    except Unsupported:
        return None
    mark = "(?U)" if parser.unicode else ""
    single = None
    if node.least == node.most == 1 and node.atom and not parser.groups and node.source[:2] not in ("(?", r"\A", r"\z"):
        single = mark + node.source
    elif node.least == 1 and node.most == INF and node.source.endswith("+") and not parser.groups:
        inner = _Parser(source[:-1]) if source.endswith("+") and not source.endswith(("\\+", "++")) else None
        try:
            one = inner.choice() if inner else None
        except Unsupported:
            one = None
        if one is not None and not inner.peek() and one.atom and one.least == one.most == 1 and one.source[:1] != "(":
            single = mark + one.source
    return Java(mark + node.source, node.least, node.most, parser.groups, single)
