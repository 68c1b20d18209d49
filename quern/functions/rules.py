"""Ordered rewriting rules, compiled once a process and applied to text in Python.

A rule is (pattern, replacement) or (pattern, replacement, flags). Longer character sets have names,
so that rules read as what they match.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import partial, reduce

import numpy as np

_parser, _compiler = getattr(re, "_parser", None), getattr(re, "_compiler", None)

HAN = "一-鿿"
HAN_COMMON = "一-龥"
LATIN = "A-Za-z"
FIELD = "A-Za-z_"
OPEN, CLOSE = "[(（]", "[)）]"
STOP = "。！？"
PAUSE = "，；、"
ANY_QUOTE = "\"'“”‘’"
FLAGS = {"s": re.DOTALL, "m": re.MULTILINE, "i": re.IGNORECASE}


#: How much a text that holds a character still says against a match: characters of any prose say little.
_COMMON = {**dict.fromkeys(" \n", 1000), **dict.fromkeys("，。.,", 30), **dict.fromkeys("-:：；、\"'()（）", 8)}


def _needed(tree: Iterable[tuple[object, object]]) -> frozenset[str] | None:
    """Characters of which every match of a parsed pattern holds at least one; None where there is no such set."""
    best = None
    for op, arg in tree:
        kind, got = str(op), None
        if kind == "LITERAL":
            got = frozenset(chr(arg))
        elif kind == "IN" and all(str(k) == "LITERAL" for k, _ in arg):
            got = frozenset(chr(c) for _, c in arg)
        elif kind == "SUBPATTERN" and not arg[1] and not arg[2]:
            got = _needed(arg[3])
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
            got = _needed(arg[2])
        elif kind == "BRANCH":
            parts = [_needed(branch) for branch in arg[1]]
            got = frozenset().union(*parts) if all(parts) else None
        if got and (best is None or _weight(got) < _weight(best)):
            best = got
    return best


def _weight(chars: frozenset[str]) -> int:
    return sum(_COMMON.get(c, 300 if c.isascii() and c.isalnum() else 1) for c in chars)


def needed(pattern: str, flags: int = 0) -> tuple[str, ...]:
    """Characters without any of which a text has no match; none where a pattern needs no certain ones."""
    parser = getattr(re, "_parser", None)  # the standard library's own; without it no pattern is skipped
    if parser is None or flags & re.IGNORECASE:
        return ()
    found = _needed(parser.parse(pattern, flags))
    return tuple(sorted(found)) if found and len(found) <= 12 else ()


def distinct(text: str) -> str:
    """The characters of a text, or the text itself where it is short."""
    if len(text) < 512:
        return text
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    seen = np.zeros(1 << 16, bool)
    seen[units] = True
    if seen[0xD800:0xE000].any():
        return "".join(set(text))
    words = np.flatnonzero(seen.view(np.uint64) != 0)  # few of the many
    row, at = np.nonzero(seen.reshape(-1, 8)[words])
    return (words[row] * 8 + at).astype("<u2").tobytes().decode("utf-16-le")


class Needs:
    """What a text must hold for a pattern to match: parts, a character of each class, and one alternative of each branching."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.classes: list[Callable[[str], object]] = []
        self.branches: list[list[Needs]] = []

    def __bool__(self) -> bool:
        return bool(self.parts or self.classes or self.branches)

    def met(self, text: str, chars: str) -> bool:
        """``chars`` are those of ``text``, and maybe more."""
        for part in self.parts:
            for c in part:
                if c not in chars:
                    return False
        for search in self.classes:
            if not search(chars):
                return False
        for branches in self.branches:
            for branch in branches:
                if branch.met(text, chars):
                    break
            else:
                return False
        for part in self.parts:
            if len(part) > 1 and part not in text:
                return False
        return True

    def add(self, tree: object, flags: int) -> None:
        """Take in a parsed pattern. What is not understood is not needed."""
        run = ""
        for op, arg in tree:
            kind, least = str(op), 1
            if kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and len(arg[2]) == 1 and str(arg[2][0][0]) == "LITERAL":
                least, arg, kind = arg[0], arg[2][0][1], "LITERALS"
            if kind in ("LITERAL", "LITERALS") and not flags & re.IGNORECASE:
                run += chr(arg) * least
                if kind == "LITERAL":
                    continue
            if run:
                self.parts.append(run)
                run = ""
            if kind in ("LITERAL", "LITERALS", "IN", "CATEGORY"):
                if kind == "IN" and str(arg[0][0]) == "NEGATE" or not least or kind == "LITERALS" and not flags & re.IGNORECASE:
                    continue
                one = (op, arg) if kind != "LITERALS" else (_parser.parse("a")[0][0], arg)
                self.classes.append(_compiler.compile(_parser.SubPattern(tree.state, [one]), flags).search)
            elif kind == "SUBPATTERN" and not arg[1] and not arg[2]:
                self.add(arg[3], flags)
            elif kind == "ATOMIC_GROUP":
                self.add(arg, flags)
            elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
                self.add(arg[2], flags)
            elif kind == "BRANCH":
                branches = [Needs() for _ in arg[1]]
                for branch, parsed in zip(branches, arg[1]):
                    branch.add(parsed, flags)
                if all(branches):
                    self.branches.append(branches)
        if run:
            self.parts.append(run)


def needs(pattern: str, flags: int = 0) -> Needs:
    found = Needs()
    if _parser is not None:  # the standard library's own; without it no pattern is skipped
        parsed = _parser.parse(pattern, flags)
        found.add(parsed, parsed.state.flags)
    return found


def squeeze(text: str, char: str) -> str:
    """Runs of a character to one of it."""
    while char * 2 in text:
        text = text.replace(char * 2, char)
    return text


def one_space(text: str) -> str:
    """Runs of white space to one space."""
    out = " ".join(text.split())
    if text[:1].isspace() and out:
        out = " " + out
    return out + " " if text[-1:].isspace() else out


def one_blank(text: str) -> str:
    """Runs of tabs and spaces to one space."""
    return squeeze(text.replace("\t", " "), " ")


def _without_pattern(pattern: str, to: str, compiled: re.Pattern[str]) -> Callable[[str], str] | None:
    """String operations that do what a frequent simple pattern does."""
    plain = {(r"\s+", " "): one_space, (r"[\t ]+", " "): one_blank, (r"\n+", " "): lambda text: squeeze(text, "\n").replace("\n", " ")}
    if (pattern, to) in plain:
        return plain[pattern, to]
    if m := re.fullmatch(r"\(\[([^\\\]^-]+)\]\)\\1\+", pattern):
        if to == r"\1":
            return lambda text: reduce(squeeze, m[1], text)
    if m := re.fullmatch(r"\[([^\\\]^-]+)\]\{2,\}|([^\\.(){}\[\]])(?:\{2,\}|\2\+)", pattern):
        many = m[1] or m[2]
        if len(to) == 1 and to in many:

            def run(text: str) -> str:
                held = [c for c in many if c in text]
                return squeeze(text, to) if held == [to] else compiled.sub(to, text) if held else text

            return run
    return None


class Rules:
    """A sequence of substitutions; one is tried only on texts that hold what its matches need."""

    def __init__(self, *rules: tuple[str, ...]):
        self.source = rules
        self.compiled, self.steps = [], []
        for pattern, to, *flags in rules:
            bits = sum(FLAGS[f] for f in "".join(flags))
            compiled = re.compile(pattern, bits)
            run = None if bits else _without_pattern(pattern, to, compiled)
            self.compiled.append((compiled, to, needed(pattern, bits)))
            self.steps.append((needs(pattern, bits).met, run or partial(compiled.sub, to), re.sub(r"\\\d", "", to)))

    def __call__(self, text: str) -> str:
        return self.run(text, distinct(text))[0]

    def run(self, text: str, chars: str) -> tuple[str, str]:
        """(what the rules make of a text, its characters); ``chars`` are those of ``text``, or more, as are those given back."""
        for met, change, added in self.steps:
            if met(text, chars):
                text = change(text)
                chars += added
        return text, chars


def delete(patterns: Iterable[str], flags: str = "") -> list[tuple[str, str, str]]:
    return [(p, "", flags) for p in patterns]


def to_fixpoint(pattern: re.Pattern[str], to: object, text: str) -> str:
    """Substitute until nothing changes."""
    before = None
    while text != before:
        before, text = text, pattern.sub(to, text)
    return text
