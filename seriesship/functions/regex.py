"""Translates the rules' regex dialect, a linear-time one, to the JVM's.

The dialects spell many things alike and mean different ones: classes such as ``[[:alpha:]]`` and ``\\pL``, ``&&`` and
``[`` inside classes, ``.``, ``^``, ``$``, ``\\s`` and ``\\b``. A pattern is read once and written anew in forms that
mean the same in the JVM; what the dialect does not have (references, look-around, possessive repeats) is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Named classes, Unicode general categories, and what \s and \w stand for.
POSIX = {
    "alnum": "0-9A-Za-z",
    "alpha": "A-Za-z",
    "ascii": r"\x{0}-\x{7f}",
    "blank": r"\x{9}\x{20}",
    "cntrl": r"\x{0}-\x{1f}\x{7f}",
    "digit": "0-9",
    "graph": r"\x{21}-\x{7e}",
    "lower": "a-z",
    "print": r"\x{20}-\x{7e}",
    "punct": r"\x{21}-\x{2f}\x{3a}-\x{40}\x{5b}-\x{60}\x{7b}-\x{7e}",
    "space": r"\x{9}-\x{d}\x{20}",
    "upper": "A-Z",
    "word": "0-9A-Za-z_",
    "xdigit": "0-9A-Fa-f",
}
CATEGORIES = set(
    "C Cc Cf Co Cs L Ll Lm Lo Lt Lu M Mc Me Mn N Nd Nl No P Pc Pd Pe Pf Pi Po Ps S Sc Sk Sm So Z Zl Zp Zs".split()
)
PERL = {"d": "0-9", "w": "0-9A-Za-z_", "s": r"\x{9}\x{a}\x{c}\x{d}\x{20}"}
CONTROLS = {"a": 7, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11}
WORD = "[0-9A-Za-z_]"
BOUNDARY = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
INSIDE = f"(?:(?<={WORD})(?={WORD})|(?<!{WORD})(?!{WORD}))"
MOST_REPEATS = 1000
_REPEAT = re.compile(r"\{([0-9]+)(,([0-9]*))?\}")
_GROUP = re.compile(r"\?P?<([A-Za-z0-9_]+)>")
_FLAGS = re.compile(r"\?([ims]*)(?:-([ims]+))?([:)])")


@dataclass
class Translated:
    """The JVM's pattern, its number of groups, and the numbers of named ones."""

    pattern: str = ""
    groups: int = 0
    names: dict[str, int] = field(default_factory=dict)


def _literal(code: int) -> str:
    c = chr(code)
    return c if code < 128 and c.isalnum() else f"\\x{{{code:x}}}"


class _Reader:
    def __init__(self, text: str, dot_all: bool) -> None:
        self.text, self.at, self.out = text, 0, Translated()
        self.flags = {"i": False, "m": False, "s": dot_all}

    def fail(self, why: str) -> ValueError:
        return ValueError(f"{why} at {self.at} in {self.text!r}")

    def peek(self, s: str) -> bool:
        return self.text.startswith(s, self.at)

    def take(self) -> str:
        if self.at >= len(self.text):
            raise self.fail("it ends too early")
        self.at += 1
        return self.text[self.at - 1]

    def read(self) -> Translated:
        parts: list[str] = []
        open_: list[dict] = []
        repeatable = repeated = False
        while self.at < len(self.text):
            c = self.text[self.at]
            m = _REPEAT.match(self.text, self.at) if c == "{" else None
            if c in "*+?" or m:
                if not repeatable or repeated:
                    raise self.fail("nothing to repeat")
                parts.append(self._repeat(m))
                repeated = True
                continue
            repeated, repeatable = False, True
            self.at += 1
            if c == "(":
                saved = dict(self.flags)
                shown, stays = self._open()
                parts.append(shown)
                if stays:
                    open_.append(saved)
                repeatable = False
            elif c == ")":
                if not open_:
                    raise self.fail("a group closes that is not open")
                self.flags = open_.pop()
                parts.append(")")
            elif c == "|":
                parts.append("|")
                repeatable = False
            elif c == "[":
                parts.append(self._class())
            elif c == ".":
                parts.append(r"[\x{0}-\x{10ffff}]" if self.flags["s"] else r"[^\x{a}]")
            elif c == "^":
                parts.append(r"(?:\A|(?<=\x{a}))" if self.flags["m"] else r"(?:\A)")
            elif c == "$":
                parts.append(r"(?:\z|(?=\x{a}))" if self.flags["m"] else r"(?:\z)")
            elif c == "\\":
                parts.append(self._escape())
            else:
                parts.append(_literal(ord(c)))
        if open_:
            raise self.fail("a group is not closed")
        self.out.pattern = "".join(parts)
        return self.out

    def _repeat(self, m: re.Match | None) -> str:
        if m:
            low, high = int(m[1]), int(m[3]) if m[3] else None
            if max(low, high or 0) > MOST_REPEATS or (high is not None and high < low):
                raise self.fail("repeat count")
            shown, self.at = m[0], m.end()
        else:
            shown = self.take()
        if self.peek("?"):
            shown += self.take()
        return shown

    def _open(self) -> tuple[str, bool]:
        """How a group begins, and whether one does: flags alone open none."""
        if not self.peek("?"):
            self.out.groups += 1
            return "(", True
        if m := _GROUP.match(self.text, self.at):
            self.at = m.end()
            self.out.groups += 1
            if m[1] in self.out.names:
                raise self.fail("two groups of one name")
            self.out.names[m[1]] = self.out.groups
            return "(", True
        m = _FLAGS.match(self.text, self.at)
        if not m or not (m[1] or m[2] or m[3] == ":"):
            raise self.fail("a group of this kind")
        self.at = m.end()
        self.flags |= dict.fromkeys(m[1], True) | dict.fromkeys(m[2] or "", False)
        fold = "iu" if self.flags["i"] else "-iu"
        return f"(?{fold}{m[3]}", m[3] == ":"

    def _code(self, c: str) -> int | None:
        """The character that an escape stands for; None if it stands for a class or a place."""
        if c == "x":
            m = re.compile(r"\{([0-9A-Fa-f]{1,6})\}|([0-9A-Fa-f]{2})").match(self.text, self.at)
            if not m or int(m[1] or m[2], 16) > 0x10FFFF:
                raise self.fail("escape")
            self.at = m.end()
            return int(m[1] or m[2], 16)
        if c in "01234567":
            m = re.compile("[0-7]{0,2}").match(self.text, self.at)
            if c != "0" and not m[0]:
                raise self.fail("a reference")
            self.at = m.end()
            return int(c + m[0], 8)
        if c in CONTROLS:
            return CONTROLS[c]
        if ord(c) < 128 and not c.isalnum():
            return ord(c)
        return None

    def _unicode(self, c: str) -> str:
        m = re.compile(r"\{(\^?)([A-Za-z_]+)\}|([A-Z])").match(self.text, self.at)
        if not m:
            raise self.fail("escape")
        self.at = m.end()
        name, out = m[2] or m[3], (c == "P") != bool(m[1])
        if name == "Any":
            return r"&&[^\x{0}-\x{10ffff}]" if out else r"\x{0}-\x{10ffff}"
        if name not in CATEGORIES and len(name) < 3:
            raise self.fail("unknown character class")
        return f"\\{'P' if out else 'p'}{{{name if name in CATEGORIES else 'Is' + name}}}"

    def _escape(self) -> str:
        c = self.take()
        if c == "Q":
            end = self.text.find("\\E", self.at)
            quoted = self.text[self.at : end if end >= 0 else len(self.text)]
            self.at = end + 2 if end >= 0 else len(self.text)
            return "".join(_literal(ord(q)) for q in quoted)
        if c in "dws":
            return f"[{PERL[c]}]"
        if c in "DWS":
            return f"[^{PERL[c.lower()]}]"
        if c in "Az":
            return f"(?:\\{c})"
        if c in "bB":
            return BOUNDARY if c == "b" else INSIDE
        if c in "pP":
            return f"[{self._unicode(c)}]"
        code = self._code(c)
        if code is None:
            raise self.fail("escape")
        return _literal(code)

    def _class(self) -> str:
        """A class: its parts, and those that are the rest of something, side by side."""
        negated = self.peek("^")
        self.at += negated
        parts: list[str] = []
        rests: list[str] = []
        first = True
        while first or not self.peek("]"):
            first = False
            if m := re.compile(r"\[:(\^?)([a-z]+):\]").match(self.text, self.at):
                if m[2] not in POSIX:
                    raise self.fail("unknown character class")
                self.at = m.end()
                (rests if m[1] else parts).append(POSIX[m[2]])
                continue
            low = self._member(parts, rests)
            if low is None:
                continue
            if self.peek("-") and not self.peek("-]"):
                self.at += 1
                high = self._member([], [])
                if high is None or high < low:
                    raise self.fail("range")
                parts.append(f"{_literal(low)}-{_literal(high)}")
            else:
                parts.append(_literal(low))
        self.at += 1
        either = ([f"[{''.join(parts)}]"] if parts else []) + [f"[^{r}]" for r in rests]
        if negated and not rests:
            return f"[^{''.join(parts)}]"
        shown = either[0] if len(either) == 1 else f"(?:{'|'.join(either)})"
        return rf"(?:(?!{shown})[\x{{0}}-\x{{10ffff}}])" if negated else shown

    def _member(self, parts: list[str], rests: list[str]) -> int | None:
        """The next character, or None for a class, which is added to its list."""
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c in "dws":
            parts.append(PERL[c])
        elif c in "DWS":
            rests.append(PERL[c.lower()])
        elif c in "pP":
            parts.append(self._unicode(c))
        else:
            code = self._code(c)
            if code is None:
                raise self.fail("escape")
            return code
        return None


def translate(regex: str, dot_all: bool = True) -> Translated:
    """The pattern for the JVM. Raises ``ValueError`` for what is not in the dialect."""
    return _Reader(regex, dot_all).read()
