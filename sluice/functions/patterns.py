"""Driver-side checks of date/time patterns.

Spark raises at run time (even inside ``try_*`` functions) for pattern
letters its parser does not accept, so every pattern is classified on the
driver before it reaches a plan.  A pattern that cannot be used turns into an
operation that fails each non-empty value, which is how a per-record parser
would report it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# The pattern letters of java.time's DateTimeFormatter.
JAVA_PATTERN_LETTERS = set("GuyDMLdQqYwWEecFahKkHmsSAnNVvzOXxZBp")
# Letters Spark's datetime parser accepts (others raise).
SPARK_PARSE_LETTERS = set("GyDMLdahKkHmsSVzOXxZ")
ZONE_LETTERS = set("VzOXxZ")
# Most letters java.time allows for one field.
MAX_LETTER_COUNT = {
    "d": 2, "H": 2, "h": 2, "K": 2, "k": 2, "m": 2, "s": 2, "D": 3,
    "M": 5, "L": 5, "G": 5, "Q": 5, "q": 5, "E": 5, "a": 1, "S": 9,
    "z": 4, "X": 5, "x": 5, "Z": 5, "O": 4, "V": 2,
}


# English day names as java.time prints them for E..EEE and EEEE.
SHORT_DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
FULL_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Text widths of the numeric fields whose width the letter count fixes.
FIXED_WIDTHS = {
    ("y", 4): 4, ("y", 2): 2, ("M", 2): 2, ("d", 2): 2, ("D", 3): 3, ("H", 2): 2, ("h", 2): 2,
    ("K", 2): 2, ("k", 2): 2, ("m", 2): 2, ("s", 2): 2,
    **{("S", n): n for n in range(1, 10)},
}


@dataclass
class PatternInfo:
    pattern: str                 # pattern handed to Spark (after rewrites)
    letters: dict[str, int] = field(default_factory=dict)
    problem: str | None = None   # set when the pattern cannot be used
    # 0-based text offsets of the year (4 digits), month and day (2 digits each)
    # when every field before them has a fixed width; else None.
    ymd_offsets: tuple[int, int, int] | None = None
    # A leading day-of-week field (E, EE, EEE or EEEE): Spark cannot parse it,
    # so it is taken off the pattern and checked against the parsed date.
    day_name_letters: int = 0
    # For patterns without fixed offsets: a regex with one group per token and
    # the group numbers of year, month and day (None when not derivable).
    field_regex: str | None = None
    token_groups: tuple[tuple[str, int], ...] = ()
    ymd_groups: tuple[int, int, int] | None = None
    month_is_text: bool = False      # MMM / MMMM
    two_digit_year: bool = False     # yy: 2000-2099
    # The whole text as a regex (fixed field widths), when every token has one,
    # with one (letter or "lit", group number) entry per token.
    full_regex: str | None = None
    full_groups: tuple[tuple[str, int], ...] = ()
    # A day name elsewhere in the pattern: the regex of the original text, the
    # group holding the name, and the groups that form the text without it.
    day_name_regex: str | None = None
    day_name_group: int = 0
    rest_groups: tuple[int, ...] = ()

    @property
    def has_zone(self) -> bool:
        return any(ch in self.letters for ch in ZONE_LETTERS)

    @property
    def has_date(self) -> bool:
        year = "y" in self.letters
        month_day = ("M" in self.letters or "L" in self.letters) and "d" in self.letters
        return year and (month_day or "D" in self.letters)

    @property
    def has_time(self) -> bool:
        return "H" in self.letters or "k" in self.letters or (
            ("h" in self.letters or "K" in self.letters) and "a" in self.letters
        )


def _tokens(pattern: str):
    """Yield ('letter', ch, count) and ('literal', text) tokens; raise on bad quoting."""
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "'":
            j = i + 1
            buf = []
            while True:
                if j >= n:
                    raise ValueError(f"Pattern ends with an incomplete string literal: {pattern}")
                if pattern[j] == "'":
                    if j + 1 < n and pattern[j + 1] == "'":
                        buf.append("'")
                        j += 2
                        continue
                    break
                buf.append(pattern[j])
                j += 1
            yield ("literal", "".join(buf) if buf else "'")
            i = j + 1
        elif ch.isascii() and ch.isalpha():
            j = i
            while j < n and pattern[j] == ch:
                j += 1
            yield ("letter", ch, j - i)
            i = j
        else:
            if ch in "{}#":
                raise ValueError(f"Pattern includes reserved character: '{ch}'")
            yield ("literal", ch)
            i += 1


def _field_rx(ch: str, count: int) -> str | None:
    """Regex of the text one numeric-or-simple field spans, or None when not expressible."""
    if ch == "y":
        return r"(\d{2})" if count == 2 else r"(\d{%d,19})" % count
    if ch in "ML" and count == 3:
        return r"([A-Za-z]{3})"
    if ch in "ML" and count == 4:
        return r"([A-Za-z]+)"
    if ch in "MLdHhKkms":
        return r"(\d{1,2})" if count == 1 else r"(\d{2})"
    if ch == "D":
        return r"(\d{%d,3})" % count
    if ch == "S":
        return r"(\d{%d})" % count
    if ch == "a":
        return r"([AaPp][Mm])"
    if ch == "E" and count <= 4:
        return "(" + "|".join(FULL_DAYS if count == 4 else SHORT_DAYS) + ")"
    if ch in ZONE_LETTERS:
        return r"(\S+)"
    return None


def _field_regex(tokens):
    """(regex, token groups, year/month/day groups, month is text, two-digit year) or None."""
    parts, groups, where, kinds = ["^"], [], {}, {}
    for tok in tokens:
        if tok[0] == "literal":
            if tok[1] in "[]":
                return None
            parts.append("(" + re.escape(tok[1]) + ")")
            groups.append(("lit", len(groups) + 1))
            continue
        ch, count = ("y" if tok[1] == "u" else tok[1]), tok[2]
        rx = _field_rx(ch, count)
        if rx is None:
            return None
        parts.append(rx)
        groups.append((ch, len(groups) + 1))
        key = "M" if ch == "L" else ch
        if key in "yMd" and key not in where:
            where[key] = len(groups)
            kinds[key] = count
    regex = "".join(parts) + r"\z"
    if len(where) != 3:
        return regex, tuple(groups), None, False, False
    return (regex, tuple(groups), (where["y"], where["M"], where["d"]),
            kinds["M"] >= 3, kinds["y"] == 2)


def _quote_literal(text: str) -> str:
    if text == "'":
        return "''"
    if any(c.isalpha() or c == "'" for c in text):
        return "'" + text.replace("'", "''") + "'"
    return text


def classify(pattern: str) -> PatternInfo:
    """Check a pattern and rewrite what Spark spells differently."""
    if pattern == "":
        return PatternInfo(pattern, problem="empty datetime pattern")
    out: list[str] = []
    letters: dict[str, int] = {}
    offsets: dict[str, int] = {}
    pos: int | None = 0          # text offset while all widths so far are fixed
    day_name = 0
    try:
        tokens = list(_tokens(pattern))
        inner_name = None
        if tokens and tokens[0][0] == "letter" and tokens[0][1] == "E" and tokens[0][2] <= 4:
            day_name = tokens[0][2]
            tokens = tokens[1:]
        else:
            e_at = [i for i, t in enumerate(tokens) if t[0] == "letter" and t[1] == "E"]
            if len(e_at) == 1 and tokens[e_at[0]][2] <= 4:
                inner_name = _field_regex(tokens)
                if inner_name is not None:
                    day_name = tokens[e_at[0]][2]
                    inner_name = (inner_name[0], e_at[0] + 1, tuple(g for _, g in inner_name[1] if g != e_at[0] + 1))
                    tokens = tokens[:e_at[0]] + tokens[e_at[0] + 1:]
        for tok in tokens:
            if tok[0] == "literal":
                out.append(_quote_literal(tok[1]))
                if pos is not None:
                    pos = None if tok[1] in "[]" else pos + len(tok[1])
                continue
            _, ch, count = tok
            if ch not in JAVA_PATTERN_LETTERS:
                raise ValueError(f"Unknown pattern letter: {ch}")
            if count > MAX_LETTER_COUNT.get(ch, 99):
                raise ValueError(f"Too many pattern letters: {ch}")
            if ch == "u":  # proleptic year; the same as year-of-era for AD years
                ch = "y"
            if ch not in SPARK_PARSE_LETTERS:
                return PatternInfo(pattern, letters, problem=f"Unsupported pattern letter for parsing: {ch}")
            letters[ch] = count
            out.append(ch * count)
            if pos is not None:
                if (ch, count) in (("y", 4), ("M", 2), ("d", 2)):
                    offsets.setdefault(ch, pos)
                width = FIXED_WIDTHS.get((ch, count))
                pos = None if width is None else pos + width
    except ValueError as exc:
        return PatternInfo(pattern, letters, problem=str(exc))
    ymd = (offsets["y"], offsets["M"], offsets["d"]) if len(offsets) == 3 else None
    info = PatternInfo("".join(out), letters, ymd_offsets=ymd, day_name_letters=day_name)
    if inner_name is not None:
        info.day_name_regex, info.day_name_group, info.rest_groups = inner_name
    derived = _field_regex(tokens)
    if derived is not None:
        info.full_regex, info.full_groups = derived[0], derived[1]
        if ymd is None and derived[2] is not None:
            (info.field_regex, info.token_groups, info.ymd_groups,
             info.month_is_text, info.two_digit_year) = derived
    return info
