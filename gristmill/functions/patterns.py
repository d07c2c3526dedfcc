"""Patterns for personal data, and a linear-time matcher for the key pattern."""

from __future__ import annotations

import unicodedata
import regex

# ---- fixed values --------------------------------------------------------
# ``\x08`` is the backspace character that ``[\b]`` stands for.
OPENING = r"(?:^|[\x08\s@?,!;:'\")(.\p{Han}])"
CLOSING_KEY = r"(?:$|[\x08\s\p{Han}@?,!;:'\")(.])"
CLOSING_IP = r"(?:$|[\s@,?!;:'\"(.\p{Han}])"
KEY_BODY = (
    r"((?:(?:[A-Za-z]+[\p{Nd}\p{Pd}\/\+\=:_]+|[\p{Nd}\p{Pd}\/\+\=:]+[A-Za-z]+)){4,}"
    r"|(?:(?:\p{Nd}{3,}|[A-Z]+\p{Nd}+[A-Z]*|\p{Nd}+[A-Z]+\p{Nd}*)[ \p{Pd}]?){3,})"
)
IPV4 = (
    r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
    r"(?:\.(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)){3}"
)
IPV6 = "|".join(
    [
        r"(?:[0-9a-fA-F]{1,4}:){7,7}[0-9a-fA-F]{1,4}",
        r"(?:[0-9a-fA-F]{1,4}:){1,7}:",
        r"(?:[0-9a-fA-F]{1,4}:){1,6}:[0-9a-fA-F]{1,4}",
        r"(?:[0-9a-fA-F]{1,4}:){1,5}(?::[0-9a-fA-F]{1,4}){1,2}",
        r"(?:[0-9a-fA-F]{1,4}:){1,4}(?::[0-9a-fA-F]{1,4}){1,3}",
        r"(?:[0-9a-fA-F]{1,4}:){1,3}(?::[0-9a-fA-F]{1,4}){1,4}",
        r"(?:[0-9a-fA-F]{1,4}:){1,2}(?::[0-9a-fA-F]{1,4}){1,5}",
        r"[0-9a-fA-F]{1,4}:(?:(?::[0-9a-fA-F]{1,4}){1,6})",
        r":(?:(?::[0-9a-fA-F]{1,4}){1,7}|:)",
        r"fe80:(?::[0-9a-fA-F]{0,4}){0,4}%[0-9a-zA-Z]{1,}",
        r"::(?:ffff(?::0{1,4}){0,1}:){0,1}"
        r"(?:(?:25[0-5]|(?:2[0-4]|1{0,1}[0-9]){0,1}[0-9])\.){3,3}"
        r"(?:25[0-5]|(?:2[0-4]|1{0,1}[0-9]){0,1}[0-9])",
        r"(?:[0-9a-fA-F]{1,4}:){1,4}:"
        r"(?:(?:25[0-5]|(?:2[0-4]|1{0,1}[0-9]){0,1}[0-9])\.){3,3}"
        r"(?:25[0-5]|(?:2[0-4]|1{0,1}[0-9]){0,1}[0-9])",
    ]
)
EMAIL = (
    r"(?<=^|[\x08\s@,?!;:)('\".\p{Han}<])"
    r"([^\x08\s@?!;,:)('\"<]+@[^\x08\s@!?;,/]*[^\x08\s@?!;,/:)('\">.]\.\p{L}\w{1,})"
    r"(?=$|[\x08\s@,?!;:)('\".\p{Han}>])"
)
USER = r"(?<=^|[)(\s@,?!;:'\"\p{Han}])(@[^)(\s@,?!;:'\"]{3,})"
DATE_OPENING = r"(?:^|[\x08\s@?,!;:'\")(.\p{Han}])"
DATE_CLOSING = r"(?:$|[\s@,?!;:'\"(.\p{Han}])"
DATES = [
    r"([1-2][0-9]{3}[\p{Pd}/][1-2][0-9]{3})",
    r"([1-2][0-9]{3}[\p{Pd}/.][0-3][0-9][\p{Pd}/.][0-3][0-9])",
    r"([0-3][0-9][\p{Pd}/.][0-3][0-9][\p{Pd}/.](?:[0-9]{2}|[1-2][0-9]{3}))",
    r"([0-3][0-9][\p{Pd}/](?:[0-9]{2}|[1-2][0-9]{3}))",
    r"([1-2][0-9]{3}-[0-3][0-9])",
]
# ---- end of fixed values -------------------------------------------------

# The digits of an ID are counted by a bounded group, so that the JVM matcher does
# not recurse once per digit.
ID_BODY = r"([A-Za-z]*(?:[\p{Pd}]*\p{Nd}){6}(?:[\p{Pd}\p{Nd}]*\p{Nd})?)"

# The same addresses as EMAIL in linear time. An address that fails at the start of a run of
# name characters fails at every later start in it, so only the start of the run is tried
# and, where the address before ends inside a run, the first start after it. The match may
# then begin before its first group.
_NAME_END = r"\x08\s@?!;,:)('\"<"
EMAIL_LINEAR = (
    rf"(?:(?<=^|[{_NAME_END}])|\G(?:(?<=[.\p{{Han}}])|(?>[^{_NAME_END}.\p{{Han}}]*+[.\p{{Han}}])))"
    + EMAIL[EMAIL.index("([^"):].replace("]+@", "]++@", 1)
)


def for_jvm(pattern: str, multiline: bool = True) -> str:
    """The pattern in Java syntax: line-feed line ends and Unicode classes."""
    return ("(?mdU)" if multiline else "(?dU)") + pattern.replace(r"\p{Han}", r"\p{IsHan}")


KEY = regex.compile(OPENING + KEY_BODY + CLOSING_KEY, flags=regex.MULTILINE)
_BOUNDARY = regex.compile(r"[\x08\s\p{Han}@?,!;:'\")(.]")


def _class_of(char: str) -> str:
    # One letter per character class of the key body; "" for any other character.
    if "A" <= char <= "Z":
        return "U"
    if "a" <= char <= "z":
        return "l"
    category = unicodedata.category(char)
    if category == "Nd":
        return "d"
    if category == "Pd":
        return "p"
    return char if char in "/+=:_ " else ""


_MARK_GROUPS = regex.compile(r"[\p{Nd}\p{Pd}/+=:_]+")
_DIGIT_GROUPS = regex.compile(r"\p{Nd}+")
# What stands between the groups of one key: letters, or capitals, dashes and blanks.
_ASCII_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_GAPS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ " + "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Pd")
_LETTERS, _MARKS, _FIRST_MARKS = frozenset("Ul"), frozenset("dp/+=:_"), frozenset("dp/+=:")


def _closing(text: str, at: int) -> int:
    """End of the closing boundary at ``at``, or -1."""
    if at == len(text) or text[at] == "\n":
        return at
    return at + 1 if _BOUNDARY.match(text[at]) else -1


class _Segment:
    """Where a key can start inside one run of key characters, and where it ends.

    Both repeated groups of the key body are automata whose states are a phase and the
    number of repetitions so far. One pass from the right notes, for each phase and
    place, the repetition counts (as bits) from which the body can still be finished. A
    walk from the left then takes the first permitted choice that can be finished, which
    is what backtracking would end up with. Time is linear in the length of the run.
    """

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start = text, start
        self.kinds = [_class_of(c) for c in text[start:end]]
        self.ends = [_closing(text, i) >= 0 for i in range(start, end + 1)]
        self.mixed = self._mixed() if self._worth(_MARKS, 4) else None
        self.digits = self._digits() if self._worth(frozenset("d"), 3) else None

    def _worth(self, kinds: frozenset, least: int) -> bool:
        return sum(k in kinds for k in self.kinds) >= least

    # Letters then marks, or marks then letters, four times or more.

    def _mixed(self) -> list[tuple[int, ...]]:
        n = len(self.kinds)
        table = [(0,) * 5] * (n + 1)
        ahead = (0,) * 5
        for i in range(n, -1, -1):
            kind = self.kinds[i] if i < n else ""
            letter, mark, first = kind in _LETTERS, kind in _MARKS, kind in _FIRST_MARKS
            _, p1, p2, q1, q2 = ahead
            again = (p1 if letter else 0) | (q1 if first else 0) | (16 if self.ends[i] else 0)
            more = (again >> 1) | (again & 16)
            ahead = (
                again,
                (p1 if letter else 0) | (p2 if mark else 0),
                (p2 if mark else 0) | more,
                (q1 if first else 0) | (q2 if letter else 0),
                (q2 if letter else 0) | more,
            )
            table[i] = ahead
        return table

    def _walk_mixed(self, i: int) -> int:
        count, phase = 0, 0
        while True:
            kind = self.kinds[i] if i < len(self.kinds) else ""
            ahead = self.mixed[i + 1] if kind else (0,) * 5
            able = lambda p: kind and ahead[p] >> count & 1  # noqa: B023, E731
            if phase == 0:
                if kind in _LETTERS and able(1):
                    i, phase = i + 1, 1
                elif kind in _FIRST_MARKS and able(3):
                    i, phase = i + 1, 3
                else:
                    return i
            elif phase in (1, 4) and kind in _LETTERS and able(phase):
                i += 1
            elif phase == 2 and kind in _MARKS and able(2):
                i += 1
            elif phase == 3 and kind in _FIRST_MARKS and able(3):
                i += 1
            elif phase == 1:
                i, phase = i + 1, 2
            elif phase == 3:
                i, phase = i + 1, 4
            else:
                count, phase = min(count + 1, 4), 0

    # Digits, or capitals and digits, three times or more, a blank or dash after each.
    # Phases: 0 start; 1-3 digits; 4 capitals, 5 digits, 6 capitals; 7 digits, 8 capitals,
    # 9 digits; 10 the blank or dash.

    def _digits(self) -> list[tuple[int, ...]]:
        n = len(self.kinds)
        table = [(0,) * 11] * (n + 1)
        ahead = (0,) * 11
        for i in range(n, -1, -1):
            kind = self.kinds[i] if i < n else ""
            d, u = kind == "d", kind == "U"
            again = ((ahead[1] | ahead[7]) if d else 0) | (ahead[4] if u else 0) | (8 if self.ends[i] else 0)
            more = (again >> 1) | (again & 8)
            after = (ahead[0] >> 1) | (ahead[0] & 8)
            gap = (after if kind in ("p", " ") else 0) | more
            six = (ahead[6] if u else 0) | gap
            nine = (ahead[9] if d else 0) | gap
            ahead = (
                again, ahead[2] if d else 0, ahead[3] if d else 0, (ahead[3] if d else 0) | gap,
                (ahead[4] if u else 0) | (ahead[5] if d else 0), (ahead[5] if d else 0) | six, six,
                (ahead[7] if d else 0) | (ahead[8] if u else 0), (ahead[8] if u else 0) | nine, nine, gap,
            )
            table[i] = ahead
        return table

    def _walk_digits(self, i: int) -> int:
        count, phase = 0, 0
        steps = {  # phase: (kind, phase after it) in order of choice
            0: (("d", 1), ("U", 4), ("d", 7)), 1: (("d", 2),), 2: (("d", 3),), 3: (("d", 3),), 4: (("U", 4), ("d", 5)),
            5: (("d", 5), ("U", 6)), 6: (("U", 6),), 7: (("d", 7), ("U", 8)), 8: (("U", 8), ("d", 9)), 9: (("d", 9),),
        }
        while True:
            kind = self.kinds[i] if i < len(self.kinds) else ""
            ahead = self.digits[i + 1] if kind else (0,) * 11
            if phase == 10:
                following = min(count + 1, 3)
                if kind in ("p", " ") and ahead[0] >> following & 1:
                    i += 1
                count, phase = following, 0
                continue
            step = next((p for k, p in steps[phase] if k == kind and ahead[p] >> count & 1), None)
            if step is not None:
                i, phase = i + 1, step
            elif phase == 0:
                return i
            else:
                phase = 10

    def end(self, at: int) -> int:
        """End of the key body that starts at ``at``, or -1."""
        i = at - self.start
        if self.mixed and self.mixed[i][0] & 1:
            return self.start + self._walk_mixed(i)
        if self.digits and self.digits[i][0] & 1:
            return self.start + self._walk_digits(i)
        return -1


def _clusters(text: str, groups: regex.Pattern, between: str, least: int) -> list[tuple[int, int]]:
    """Spans of ``groups`` with nothing but ``between`` among and around them, that have ``least`` characters in groups.

    Every gap of the text is looked at from both sides once.
    """
    spans = [m.span() for m in groups.finditer(text)]
    out, k = [], 0
    while k < len(spans):
        first, last = spans[k]
        size, before = last - first, spans[k - 1][1] if k else 0
        k += 1
        while k < len(spans) and not text[last:spans[k][0]].strip(between):
            size += spans[k][1] - spans[k][0]
            last = spans[k][1]
            k += 1
        if size >= least:
            after = text[last:spans[k][0] if k < len(spans) else len(text)]
            left = len(text[before:first].rstrip(between)) + before
            out.append((left, last + len(after) - len(after.lstrip(between))))
    return out


def _runs(text: str) -> list[tuple[int, int]]:
    """Where keys may be: four marks among letters, or three digits among capitals, dashes and blanks."""
    found = sorted(
        _clusters(text, _MARK_GROUPS, _ASCII_LETTERS, 4) + _clusters(text, _DIGIT_GROUPS, _GAPS, 3))
    out: list[tuple[int, int]] = []
    for first, last in found:
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def key_hits(text: str) -> list[tuple[str, int, int]]:
    """``(value, start, end)`` of each key, as ``KEY`` finds them; spans include the boundaries.

    Only the places that have enough digits or marks close together are looked at, each
    in time linear in its length.
    """
    hits, done = [], 0
    for first, last in _runs(text):
        if last < done:
            continue
        segment = _Segment(text, first, last)
        at = max(first, done)
        while at < last:
            # A boundary stands before the body: the start of a line, or one character that
            # no earlier hit has taken.
            line = at == 0 or text[at - 1] == "\n"
            opened = at - 1 >= done and at > 0 and _BOUNDARY.match(text[at - 1])
            end = segment.end(at) if line or opened else -1
            if end < 0:
                at += 1
                continue
            begin = at - 1 if opened else at
            done = _closing(text, end)
            hits.append((text[at:end], begin, done))
            at = max(done, at)
    return hits
