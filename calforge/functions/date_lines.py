"""Dates and times in running text: a small grammar, as SQL text for one expression per line.

    date  = point { connector [weekday] point }       the last point has a month
    point = 2026-05-03 | 3.5.2026 | 03.05.26 | 3.5. | 3/5/2026 (day first) | 3. Mai [2026] | 3 May 2026 | 3.
    connector = '-' | 'bis' | 'to' (every day from one to the next)  |  ',' | '/' | '&' | '+' | 'und' | 'and' (both)
    time  = [um|ab|ca.|Beginn|Einlass] 20:00 [Uhr] | 19.30 Uhr | 20 Uhr, also '20-22 Uhr' (its start)

A point takes a missing month from the next one that has it. Years: if the last point has one, the
points before it take it, or the year before where they would follow it (30.12.-2.1.2027); otherwise
the first point takes its own or the default year and later ones the next year where they would
precede (30.12.-2.1.). A range that is no range (its end before its start, an impossible date, more
than MOST_DAYS days) gives its two ends. A date takes the time that follows it, before any other
date; without one the first time of its line, if there is one.
"""

from __future__ import annotations

from calforge.functions.html import bind, quoted

#: The longest span that is read as a range of days.
MOST_DAYS = 366

# Month names by their first three letters, weekdays, connectors.
MONTHS = {"jan": 1, "jän": 1, "feb": 2, "mär": 3, "mae": 3, "mrz": 3, "mar": 3, "apr": 4, "mai": 5, "may": 5, "jun": 6, "jul": 7,
          "aug": 8, "sep": 9, "okt": 10, "oct": 10, "nov": 11, "dez": 12, "dec": 12}
_NAME = (r"(?:jan(?:uary?|ner)?|jänner|feb(?:ruary?)?|märz?|maerz|mrz|mar(?:ch)?|apr(?:il)?|mai|may|jun[ie]?|jul[iy]?|aug(?:ust)?|"
         r"sept?(?:ember)?|okt(?:ober)?|oct(?:ober)?|nov(?:ember)?|de[zc](?:ember)?)(?!\p{L})")
_WEEKDAY = (r"(?:(?<!\p{L})(?:mo(?:ntag|nday)?|di(?:enstag)?|tue(?:sday)?|mi(?:ttwoch)?|wed(?:nesday)?|do(?:nnerstag)?|thu(?:rsday)?|"
            r"fr(?:eitag|iday)?|sa(?:mstag|turday)?|so(?:nntag)?|sun(?:day)?)(?!\p{L})[.,]*\s*)?")
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "[0-9]{4}"
_END = r"(?![0-9.]*[0-9])"
_ISO = rf"{_YEAR}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])"
_POINT = (rf"(?:{_ISO}|{_DAY}\.{_MONTH}\.(?:{_YEAR}{_END}|[0-9]{{2}}{_END}|(?![0-9]))|{_DAY}/{_MONTH}/{_YEAR}(?![0-9/])|"
          rf"{_DAY}\.\s?{_NAME}(?:\.?\s?{_YEAR}(?![0-9]))?|{_DAY}\s{_NAME}\.?\s{_YEAR}(?![0-9]))")
_LEAD = rf"(?:{_POINT}|{_DAY}\.)"
_THROUGH = r"(?:-|–|—|bis(?:\szum)?(?!\p{L})|to(?!\p{L}))"
_ALSO = r"(?:,|/|&|\+|und(?!\p{L})|and(?!\p{L}))"
DATE_RE = rf"(?:(?<!\p{{L}})(?:am|vom|von)\s)?{_WEEKDAY}(?<![0-9./])(?:{_LEAD}\s?(?:{_THROUGH}|{_ALSO})\s?{_WEEKDAY})*{_POINT}"
_HOUR = "(?:2[0-3]|[01]?[0-9])"
_CLOCK = rf"{_HOUR}(?:[:.][0-5][0-9])?"
TIME_RE = (rf"(?:(?<!\p{{L}})(?:um|ab|ca\.|beginn:?|einlass:?)\s)?(?<![0-9.:])"
           rf"(?:{_CLOCK}(?:\s?(?:-|–|bis)\s?{_CLOCK})?\s?uhr(?!\p{{L}})|{_HOUR}:[0-5][0-9](?:\s?(?:-|–|bis)\s?{_HOUR}:[0-5][0-9])?(?![0-9]))")
# Every date or time starts with a digit, or with a lead word or weekday that follows no letter: elsewhere nothing is tried.
_START = r"(?:(?=[0-9])|(?<!\p{L})(?=[abcdefmstuvw]))"
TOKEN_RE = rf"(?iu){_START}(?:(?:{DATE_RE})|(?:{TIME_RE}))"
#: What every line with a date has: a digit before a dot, slash, dash or a word.
GUARD_RE = r"[0-9](?:[./-]| ?\p{L})"
_POINTS_RE = rf"(?iu){_LEAD}"
SEPARATORS = " \t|,;:–—-·@/()"


_OPEN, _SHUT = quoted("\u0001"), quoted("\u0002")


def marked(line: str) -> str:
    """A line with its dates and times between marks, from one pass of the grammar; NULL where it
    can have none, or holds a mark itself."""
    return (f"IF(rlike({line}, {quoted(GUARD_RE)}) AND NOT contains({line}, {_OPEN}) AND NOT contains({line}, {_SHUT}), "
            f"regexp_replace({line}, {quoted(TOKEN_RE)}, {quoted(chr(1) + '$0' + chr(2))}), CAST(NULL AS string))")


def tokens(line: str, marks: str) -> str:
    """The dates and times of a line (``marks``: it ``marked``), in order, as they are written."""
    found = f"transform(slice(split({marks}, {_OPEN}), 2, {1 << 30}), w -> substring_index(w, {_SHUT}, 1))"
    own = (f"IF((contains({line}, {_OPEN}) OR contains({line}, {_SHUT})) AND rlike({line}, {quoted(GUARD_RE)}), "
           f"regexp_extract_all({line}, {quoted(TOKEN_RE)}, 0), array())")
    return f"IF({marks} IS NOT NULL, {found}, {own})"


def is_time(token: str) -> str:
    return f"rlike({token}, '(?i):[0-5][0-9]|uhr')"


def has_date(toks: str) -> str:
    return f"exists({toks}, k -> NOT {is_time('k')})"


def start_time(token: str) -> str:
    """HH:MM of a time."""
    clock = f"split(replace(regexp_extract({token}, {quoted(rf'(?i)(?<![0-9.:]){_CLOCK}')}, 0), '.', ':'), ':')"
    return bind(clock, "hm", "concat(lpad(get(hm, 0), 2, '0'), ':', coalesce(get(hm, 1), '00'))")


def _point(p: str) -> str:
    """``y, m, d`` of a point, NULL where it does not say."""
    months = quoted(",".join(f"{k}:{v}" for k, v in MONTHS.items()))
    number = "CAST(get(nums, {0}) AS int)"
    year = f"IF(length(get(nums, k)) = 2, 2000, 0) + {number.format('k')}"
    name = f"try_element_at(str_to_map({months}, ',', ':'), substring(lower(regexp_extract({p}, {quoted(r'\p{L}+')}, 0)), 1, 3))"
    iso = f"named_struct('y', {number.format(0)}, 'm', {number.format(1)}, 'd', {number.format(2)})"
    named = f"named_struct('y', {number.format(1)}, 'm', CAST(name AS int), 'd', {number.format(0)})"
    dotted = f"named_struct('y', {bind('2', 'k', year)}, 'm', {number.format(1)}, 'd', {number.format(0)})"
    body = f"CASE WHEN length(get(nums, 0)) = 4 THEN {iso} WHEN name IS NOT NULL THEN {named} ELSE {dotted} END"
    return bind(f"regexp_extract_all({p}, '[0-9]+', 0)", "nums", bind(name, "name", body))


def _years(default_year: int) -> str:
    """``pts`` (months filled in) with their years."""
    kind = "array<struct<y:int,m:int,d:int>>"
    state = "named_struct('pts', array_append(a.pts, named_struct('y', y, 'm', p.m, 'd', p.d)), 'y', y, 'at', p.m * 100 + p.d)"
    zero = "named_struct('pts', CAST(array() AS {0}), 'y', {1}, 'at', {2})"

    def walk(points, first, at, moved):
        year = f"coalesce(p.y, a.y + {moved})"
        return f"aggregate({points}, {zero.format(kind, first, at)}, (a, p) -> {bind(year, 'y', state)}, a -> a.pts)"

    back = walk("reverse(pts)", "0", "9999", "IF(p.m * 100 + p.d > a.at, -1, 0)")
    on = walk("pts", str(default_year), "0", "IF(p.m * 100 + p.d < a.at, 1, 0)")
    return f"IF(element_at(pts, -1).y IS NOT NULL, reverse({back}), {on})"


def days(token: str, default_year: int) -> str:
    """All days of a date as YYYY-MM-DD texts (an impossible day stays a text)."""
    points = f"transform(regexp_extract_all({token}, {quoted(_POINTS_RE)}, 0), w -> {_point('w')})"
    filled = ("transform(raw, (p, i) -> named_struct('y', p.y, 'm', "
              "coalesce(p.m, get(filter(slice(raw, i + 1, size(raw)), q -> q.m IS NOT NULL), 0).m), 'd', p.d))")
    text = "format_string('%04d-%02d-%02d', p.y, p.m, p.d)"
    through = f"rlike(get(gaps, i + 1), {quoted(r'(?i)[-–—]|(?<!\p{L})(?:bis|to)(?!\p{L})')})"
    span = (f"IF({through} AND datediff(get(dates, i + 1), get(dates, i)) BETWEEN 1 AND {MOST_DAYS}, "
            "transform(sequence(get(dates, i), date_sub(get(dates, i + 1), 1)), x -> CAST(x AS string)), array(t))")
    spans = f"flatten(transform(texts, (t, i) -> {span}))"
    with_dates = bind("transform(texts, t -> try_to_date(t, 'yyyy-MM-dd'))", "dates", bind(f"split({token}, {quoted(_POINTS_RE)}, -1)", "gaps", spans))
    several = bind(filled, "pts", bind(f"transform({_years(default_year)}, p -> {text})", "texts", with_dates))
    # most dates are one point: its own year or the default, and no span to look for
    one = f"transform(raw, p -> format_string('%04d-%02d-%02d', coalesce(p.y, {default_year}), p.m, p.d))"
    any_date = bind(points, "raw", f"IF(size(raw) = 1, {one}, {several})")
    # and most of those are 2026-05-03, 3.5.2026 or 3.5., which need no reading of points
    dotted = bind(f"regexp_extract_all({token}, '[0-9]+', 0)", "nums",
                  f"array(concat(coalesce(get(nums, 2), '{default_year:04d}'), '-', lpad(get(nums, 1), 2, '0'), '-', lpad(get(nums, 0), 2, '0')))")
    return (f"CASE WHEN rlike({token}, {quoted(r'\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z')}) THEN array({token}) "
            f"WHEN rlike({token}, {quoted(r'\A[^0-9]*[0-9]{1,2}\.[0-9]{1,2}\.(?:[0-9]{4})?\z')}) THEN {dotted} ELSE {any_date} END")


def occasions(toks: str, default_year: int) -> str:
    """Every day of a line's dates with its time (NULL without one): array of ``day, time``."""
    first = f"get(filter(tk, k -> {is_time('k')}), 0)"
    own = f"IF({is_time('get(tk, j + 1)')}, get(tk, j + 1), fst)"
    with_time = bind(own, "tm", f"transform({days('tok', default_year)}, dy -> named_struct('day', dy, 'time', IF(tm IS NULL, NULL, {start_time('tm')})))")
    each = (f"flatten(transform(tk, (tok, j) -> IF({is_time('tok')}, "
            f"CAST(array() AS array<struct<day:string,time:string>>), {with_time})))")
    return bind(toks, "tk", bind(first, "fst", each))


def without_dates(line: str, marks: str) -> str:
    """What a line says besides its dates and times (``marks``: it ``marked``)."""
    parts = f"transform(split({marks}, {_OPEN}), (w, j) -> IF(j = 0, w, substring_index(w, {_SHUT}, -1)))"
    rest = f"IF({marks} IS NOT NULL, array_join({parts}, ' '), regexp_replace({line}, {quoted(TOKEN_RE)}, ' '))"
    joined = rf"regexp_replace(rest, {quoted(r'\s*([|,;·])(?:\s*[|,;·])+\s*')}, ' $1 ')"
    once = f"IF(rlike(rest, {quoted(r'[|,;·]\s*[|,;·]')}), {joined}, rest)"
    return bind(rest, "rest", f"btrim(regexp_replace({once}, ' {{2,}}', ' '), {quoted(SEPARATORS)})")
