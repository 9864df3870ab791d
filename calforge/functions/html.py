"""HTML -> text by expressions over a page's tokens (JVM side, no parser per row).

A page is cut at its comments, raw elements (script, style) and tags; what stands between them
are its text nodes, joined by '\\n' (so removed elements, comments and tags become line breaks).
Noise elements end where a parser ends them: a fold over the tags keeps the open elements, an end
tag closes the innermost open element of its name with everything inside it, one without an open
element is ignored, and what is never closed runs to the end of the page. Pages without a noise
element skip the fold. References are decoded last, each once.

The ``*_sql`` helpers are the oracle's: plain patterns of their own for the flat, well-formed
pages of the fixtures.
"""

from __future__ import annotations

import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from calforge.functions.text import WS, ustrip, ustrip_sql

# Element subtrees dropped before taking the text, and the extra set
# used by the content-node profile (void tags meta/link removed as single tags).
NOISE_TAGS: tuple[str, ...] = ("script", "style", "nav", "footer", "header")
CONTENT_NOISE_TAGS: tuple[str, ...] = ("script", "style", "nav", "footer", "header", "aside")
VOID_NOISE_TAGS: tuple[str, ...] = ("meta", "link")

# Elements that hold nothing, with the obsolete ones that parsers still know.
VOID_TAGS: tuple[str, ...] = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
    "basefont", "bgsound", "command", "frame", "image", "isindex", "keygen", "menuitem", "nextid", "spacer")

# The references that occur in the oracle's tables ('&amp;' is applied last,
# separately). The Spark side decodes every named and numeric reference.
ENTITIES: tuple[tuple[str, str], ...] = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#34;", '"'),
    ("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&copy;", "©"), ("&reg;", "®"),
    ("&middot;", "·"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&euro;", "€"), ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"),
    ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&szlig;", "ß"),
)

# Every named reference of HTML 5, dealt into buckets by a checksum of its name, so that a look-up
# reads a few names; those that stand without a semicolon too, as one pattern, longest first.
_BUCKETS, _ROW, _PAIR, _IS = 1024, "\u0002", "\u0004", "\u0003"


def _bucketed(table: dict[str, str]) -> str:
    rows: list[list[str]] = [[] for _ in range(_BUCKETS)]
    for name, value in table.items():
        rows[zlib.crc32(name.encode()) % _BUCKETS].append(f"{name}{_IS}{value}")
    return _ROW.join(_PAIR.join(r) for r in rows)


_NAMED_TEXT = _bucketed(html5)
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
# Numbers that stand for windows-1252 bytes, and those that stand for nothing.
_BYTES_TEXT = _PAIR.join(f"{b}{_IS}{bytes([b]).decode('cp1252', 'ignore') or chr(b)}" for b in range(128, 160))
REF_RE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

COMMENT_RE = r"(?s)<!--.*?-->"
# The attributes of a tag: a quoted value is read whole, so a '>' inside it ends nothing.
# Possessive throughout, so a tag of any length needs no stack.
ATTRS = r"(?:[^>=]++|=\s*+(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27)?+)*+"
TAG_RE = rf"<[a-zA-Z/!?]{ATTRS}>"
_VALUE = r"(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27|[^\s>\x22\x27]*+)"
# Elements whose content is no markup: left open, they run to the end of the page.
RAW_TAGS = ("script", "style")
RAW_RE = rf"<({'|'.join(RAW_TAGS)})(?:[\s/]{ATTRS})?>.*?(?:</\1\s*+>|\z)"
# Whatever is no text node: a comment, a raw element with its content, a tag.
TOKEN_RE = rf"(?is)<(?:!--.*?-->|{RAW_RE[1:]}|{TAG_RE[1:]})"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def re2(pattern: str) -> str:
    """The oracle's engine has no possessive quantifiers (and needs none)."""
    return pattern.replace("*+", "*").replace("++", "+").replace("?+", "?")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), 0)


# -- expressions as text -------------------------------------------------------------
# The larger expressions are written as SQL text: one call to the JVM instead of one for each
# of some hundred nodes, which had been most of a small query's time.

def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(value: str, name: str, body: str) -> str:
    """``let`` in SQL text: ``name`` stands for ``value`` in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def applied(col, name: str, body: str) -> Column:
    """``body`` with ``name`` standing for a column."""
    return F.get(F.call_function("transform", F.array(_c(col)), F.expr(f"{name} -> {body}")), 0)


def pieces(name: str, pattern: str) -> str:
    """``split(name, pattern)`` with the pattern compiled once for all rows (``split`` compiles it for
    each): matches become a mark and the mark is split at. A text that holds the mark is split itself."""
    mark, p = quoted("\u0001"), quoted(pattern)
    return f"IF(contains({name}, {mark}), split({name}, {p}), split(regexp_replace({name}, {p}, {mark}), {mark}))"


def _one_of(name: str, values) -> str:
    return f"{name} IN ({', '.join(quoted(v) for v in values)})"


# -- noise elements ------------------------------------------------------------------

_TOKENS = f"regexp_extract_all(h, {quoted(TOKEN_RE)}, 0)"
_NODES = f"split(h, {quoted(TOKEN_RE)}, -1)"


def _steps() -> str:
    """What each of ``tags`` does to the open elements: 'x' opens, '/x' closes, '' does nothing."""
    name = f"lower(regexp_extract(tag, {quoted(r'\A<(/?[a-zA-Z][^\s/>]*)')}, 1))"
    nothing = f"{_one_of('n', (*RAW_TAGS, *VOID_TAGS))} OR (endswith(tag, '/>') AND NOT startswith(n, '/'))"
    plain = bind(name, "n", f"IF({nothing}, '', regexp_replace(n, {quoted(r'[^\x21-\x7e]')}, '?'))")
    return f"transform(tags, tag -> IF(startswith(tag, '<!') OR startswith(tag, '<?'), '', {plain}))"


def noise_cuts(noise) -> str:
    """Noise elements of a page as ranges of its tokens ``tags``: ``(lo, hi, last)`` opens at token
    ``lo``; the text nodes lo+1..hi and the tokens lo..last are inside. The open elements are one
    string of names ('/html/body/'), so that closing is a search from its end."""
    kinds = tuple(t for t in noise if t not in RAW_TAGS)

    def state(open_, size, at, lo, cuts, i="a.i + 1"):
        return f"named_struct('open', {open_}, 'size', {size}, 'at', {at}, 'lo', {lo}, 'cuts', {cuts}, 'i', {i})"

    def cut(last):
        return f"array_append(a.cuts, named_struct('lo', a.lo, 'hi', a.i, 'last', {last}))"

    zero = state("'/'", "1", "-1", "0", "CAST(array() AS array<struct<lo:int,hi:int,last:int>>)", "0")
    idle = state("a.open", "a.size", "a.at", "a.lo", "a.cuts")
    begins = f"a.at < 0 AND {_one_of('n', kinds)}"
    opened = state("concat(a.open, n, '/')", "a.size + octet_length(n) + 1", f"IF({begins}, a.size, a.at)", f"IF({begins}, a.i, a.lo)", "a.cuts")
    # size of the names that stay open; as it was if none of this name is
    inner = "octet_length(substring_index(a.open, concat(n, '/'), -1))"
    left = bind(inner, "k", "IF(k = a.size, a.size, a.size - k - octet_length(n))")
    ends = "a.at >= 0 AND z <= a.at"
    closed = bind(left, "z", state("IF(z = a.size, a.open, substring(a.open, 1, z))", "z", f"IF({ends}, -1, a.at)", "a.lo",
                                   f"IF({ends}, {cut('IF(z = a.at, a.i, a.i - 1)')}, a.cuts)"))
    # a noise element that stays open takes the rest
    return (f"aggregate({_steps()}, {zero}, (a, n) -> CASE WHEN n = '' THEN {idle} WHEN startswith(n, '/') THEN {closed} ELSE {opened} END, "
            f"a -> IF(a.at >= 0, {cut('a.i')}, a.cuts))")


def _has(noise) -> str:
    """A page with an element that the fold must follow."""
    return rf"(?i)<(?:{'|'.join(t for t in noise if t not in RAW_TAGS)})[\s/>]"


def strip_blocks(col, tags=NOISE_TAGS, void_tags=()) -> Column:
    """The page without its noise elements, each of them a line break."""
    any_of = _has((*(t for t in tags if t not in RAW_TAGS), *void_tags)) + rf"|(?i)<(?:{'|'.join(RAW_TAGS)})[\s/>]"
    gone = rf"(?i)\A<(?:{'|'.join((*RAW_TAGS, *void_tags))})[\s/>]"
    after = (f"CASE WHEN exists(cuts, c -> i = c.lo) THEN '\\n' WHEN exists(cuts, c -> i > c.lo AND i <= c.last) THEN '' "
             f"WHEN rlike(get(tags, i), {quoted(gone)}) THEN '\\n' ELSE coalesce(get(tags, i), '') END")
    part = f"concat(IF(exists(cuts, c -> i > c.lo AND i <= c.hi), '', node), {after})"
    rebuilt = bind(noise_cuts(tags), "cuts", f"array_join(transform({_NODES}, (node, i) -> {part}), '')")
    return applied(col, "h", f"IF(rlike(h, {quoted(any_of)}), {bind(_TOKENS, 'tags', rebuilt)}, h)")


def text_nodes(col, noise=NOISE_TAGS) -> Column:
    """Text nodes outside noise elements, joined by line breaks, references decoded."""
    nodes = f"array_join(filter({_NODES}, (node, i) -> NOT exists(cuts, c -> i > c.lo AND i <= c.hi)), '\\n')"
    outside = bind(_TOKENS, "tags", bind(noise_cuts(noise), "cuts", nodes))
    flat = f"regexp_replace(h, {quoted(TOKEN_RE)}, '\\n')"
    return decode_entities(applied(col, "h", f"IF(rlike(h, {quoted(_has(noise))}), {outside}, {flat})"))


def strip_blocks_sql(expr: str, tags=NOISE_TAGS, void_tags=()) -> str:
    for tag in tags:
        expr = f"regexp_replace({expr}, '(?is)<{tag}(\\s[^>]*)?>.*?</{tag}>', chr(10), 'g')"
    for tag in void_tags:
        expr = f"regexp_replace({expr}, '(?i)<{tag}(\\s[^>]*)?>', chr(10), 'g')"
    return expr


# -- references ----------------------------------------------------------------------

def _character() -> str:
    """What stands for ``ref``, the text behind '&' (semicolon included, if there is one); a name
    that only begins with a known one keeps its rest, an unknown name stays as it is."""
    pair, is_ = quoted(_PAIR), quoted(_IS)

    def named(name):
        bucket = f"get(split({quoted(_NAMED_TEXT)}, {quoted(_ROW)}), CAST(pmod(crc32(CAST({name} AS binary)), {_BUCKETS}) AS int))"
        return f"try_element_at(str_to_map({bucket}, {pair}, {is_}), {name})"

    begun = bind(f"regexp_extract(ref, {quoted(rf'\A(?:{_BARE})')}, 0)", "known",
                 f"IF(known <> '', concat({named('known')}, substring(ref, length(known) + 1)), concat('&', ref))")
    digits = "substring(ltrim('0', substring(rtrim(';', ref), {0})), 1, 8)"
    number = f"try_cast(IF(rlike(ref, '^#[xX]'), conv({digits.format(3)}, 16, 10), {digits.format(2)}) AS bigint)"
    byte = f"try_element_at(str_to_map({quoted(_BYTES_TEXT)}, {pair}, {is_}), CAST(n AS string))"
    bad = "n IS NULL OR n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111"
    nothing = "(n BETWEEN 1 AND 31 AND n NOT IN (9, 10, 12, 13)) OR n = 127 OR n BETWEEN 64976 AND 65007 OR pmod(n, 65536) >= 65534"
    code = "decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32')"
    numeric = bind(number, "n", f"CASE WHEN {bad} THEN '\ufffd' WHEN n BETWEEN 128 AND 159 THEN {byte} WHEN {nothing} THEN '' ELSE {code} END")
    return f"IF(startswith(ref, '#'), {numeric}, coalesce({named('ref')}, {begun}))"


_DECODED = (f"array_join(zip_with({pieces('s', REF_RE)}, regexp_extract_all(s, {quoted(REF_RE)}, 1), "
            f"(text, ref) -> concat(text, coalesce({_character()}, ''))), '')")


def decode_entities(col) -> Column:
    """All named and numeric character references, each read once (so '&amp;lt;' gives
    '&lt;'), with or without their semicolon; text without '&' is left alone."""
    return applied(col, "s", f"IF(contains(s, '&'), {_DECODED}, s)")


def _sql_lit(s: str) -> str:
    if s in (" ",) or not s.isascii():
        return f"chr({ord(s)})" if len(s) == 1 else "'" + s.replace("'", "''") + "'"
    return "'" + s.replace("'", "''") + "'"


def decode_entities_sql(expr: str) -> str:
    for ent, ch in ENTITIES:
        expr = f"replace({expr}, '{ent}', {_sql_lit(ch)})"
    return f"replace({expr}, '&amp;', '&')"


def tags_to_breaks(col) -> Column:
    """Comments, doctype and every tag -> '\\n', then decode entities."""
    c = F.regexp_replace(_c(col), COMMENT_RE, "\n")
    c = F.regexp_replace(c, TAG_RE, "\n")
    return decode_entities(c)


def tags_to_breaks_sql(expr: str) -> str:
    expr = f"regexp_replace({expr}, '(?s)<!--.*?-->', chr(10), 'g')"
    expr = f"regexp_replace({expr}, '<[a-zA-Z/!?][^>]*>', chr(10), 'g')"
    return decode_entities_sql(expr)


# -- element helpers used by the listing extractors ---------------------------------

def _start(tag: str, attr: str, whole: str) -> str:
    """Start tag whose first ``attr`` has the value ``whole``: the attributes before it are
    read one by one, with their quotes."""
    at = rf"[^>=]*?[\s\x22\x27/]{attr}\s*="
    return rf"<{tag}(?=[\s/])(?:(?!{at})[^>=]*+=\s*+{_VALUE})*+{at}\s*+{whole}"


def _start_sql(tag: str, attr: str, whole: str) -> str:
    return (rf"<{tag}(?:[\s/](?:[^>=]*=\s*{re2(_VALUE)})*?[^>=]*?)??[\s\x22\x27/]{attr}\s*=\s*" + re2(whole))


def _one_token(token: str) -> str:
    t = rf"(?-i:{token})"
    quoted = "|".join(rf"{q}(?:[^{q}]*\s)?{t}(?:\s[^{q}]*)?{q}" for q in (r"\x22", r"\x27"))
    return rf"(?:(?:{quoted}){ATTRS}>|{t}(?:[\s/]{ATTRS})?>)"


def _whole_value(value: str) -> str:
    v = rf"(?-i:{value})"
    return rf"(?:(?:\x22{v}\x22|\x27{v}\x27){ATTRS}>|{v}(?:[\s/]{ATTRS})?>)"


def start_tag_re(tag: str, token: str) -> str:
    """Start tag of a ``tag`` with ``token`` among its classes (a whole token, not a prefix
    of 'token-title'); any quoting. ``token`` must be regex-safe."""
    return "(?is)" + _start(tag, "class", _one_token(token))


def start_tag_re_sql(tag: str, token: str) -> str:
    return "(?is)" + _start_sql(tag, "class", _one_token(token))


def element_inner_re_sql(tag: str, token: str) -> str:
    """Oracle form: first ``<tag class~=token>…</tag>``, flat; group 1 is the inner html."""
    return rf"{start_tag_re_sql(tag, token)}(.*?)</{tag}\s*>"


def start_id_re(tag: str, elem_id: str | None) -> str:
    return "(?is)" + (_start(tag, "id", _whole_value(elem_id)) if elem_id else rf"<{tag}(?:[\s/]{ATTRS})?>")


def start_id_re_sql(tag: str, elem_id: str | None) -> str:
    if elem_id:
        return "(?is)" + _start_sql(tag, "id", _whole_value(elem_id))
    return re2(start_id_re(tag, elem_id))


def inner_of_rest(rest: Column, tag: str) -> Column:
    """Inner html of an element from the text after its start tag, nesting respected. If an end
    tag is the first of its name, the element is what stands before it. Otherwise the text is cut
    before every start/end tag of the same name, and a fold over the pieces (state: depth, index)
    finds the piece where the depth returns to 0; the element is everything before it. An element
    that is never closed runs to the end, as a DOM parser closes it at the end of the document."""
    close, open_ = quoted(rf"(?i)\A</{tag}\s*>"), quoted(rf"(?i)\A<{tag}[\s/>]")
    step = bind(f"CASE WHEN a.done >= 0 THEN a.depth WHEN rlike(piece, {close}) THEN a.depth - 1 WHEN rlike(piece, {open_}) THEN a.depth + 1 "
                "ELSE a.depth END", "d", "named_struct('depth', d, 'i', a.i + 1, 'done', IF(a.done < 0 AND d = 0, a.i, a.done))")
    folded = f"aggregate(pieces, named_struct('depth', 1, 'i', 0, 'done', -1), (a, piece) -> {step}, a -> a.done)"
    nested = bind(f"split(rest, {quoted(rf'(?i)(?=<{tag}[\s/>])|(?=</{tag}\s*>)')})", "pieces",
                  bind(folded, "done", "array_join(IF(done >= 0, slice(pieces, 1, done), pieces), '')"))
    first = f"regexp_extract(rest, {quoted(rf'(?i)<(?:/{tag}\s*>|{tag}[\s/>])')}, 0)"
    return applied(rest, "rest", bind(first, "tag", f"CASE WHEN tag = '' THEN rest WHEN startswith(tag, '</') THEN substring_index(rest, tag, 1) "
                                                    f"ELSE {nested} END"))


def inner_html(col, tag: str, start: str) -> Column:
    """Inner html of the first element that begins with ``start``; NULL without one."""
    return inner_of_rest(F.get(F.regexp_extract_all(_c(col), F.lit(rf"{start}((?s:.*))"), F.lit(1)), 0), tag)


def attribute(tag_text: Column, attr: str) -> Column:
    """Value of the first ``attr`` of a start tag, references decoded; NULL without one."""
    at = rf"[^>=]*?[\s\x22\x27/]{attr}\s*="
    raw = F.regexp_extract(tag_text, rf"(?is)\A<[a-z0-9-]+(?=[\s/])(?:(?!{at})[^>=]*+=\s*+{_VALUE})*+"
                                     rf"{at}\s*+({_VALUE})", 1)
    value = let(raw, lambda v: F.when(v.rlike(r"\A[\x22\x27]"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    return decode_entities(F.when(raw != "", value))


# text of an inner-html fragment, Python get_text(strip=True): every text node
# stripped, empty ones dropped, joined by ``sep``
_NODE = "\u0001"


def get_text_strip(col, sep: str = "") -> Column:
    """``get_text(separator=sep, strip=True)`` of an html fragment. One without tags and references
    is a single text node."""
    def nodes(fragment):
        tags = F.regexp_replace(F.regexp_replace(fragment, COMMENT_RE, _NODE), TAG_RE, _NODE)
        return let(decode_entities(F.when(fragment.contains("<"), tags).otherwise(fragment)),
                   lambda c: F.when(c.contains(_NODE), joined(c)).otherwise(ustrip(c)))

    def joined(c):
        # possessive, so that a page of any number of tags needs no stack;
        # each boundary with its surrounding blanks (and empty nodes) -> one separator
        c = F.regexp_replace(c, rf"(?:{WS}*\x{{01}})++{WS}*", _NODE)
        c = ustrip(F.regexp_replace(ustrip(c), rf"\A\x{{01}}+|\x{{01}}+\z", ""))
        return F.replace(c, F.lit(_NODE), F.lit(sep))

    return let(_c(col), lambda c: F.when(c.contains("<") | c.contains("&") | c.contains(_NODE), nodes(c)).otherwise(ustrip(c)))


def get_text_strip_sql(expr: str, sep: str = "") -> str:
    node = "chr(1)"
    expr = f"regexp_replace({expr}, '(?s)<!--.*?-->', {node}, 'g')"
    expr = f"regexp_replace({expr}, '<[a-zA-Z/!?][^>]*>', {node}, 'g')"
    expr = decode_entities_sql(expr)
    expr = f"regexp_replace({expr}, '({WS}*\\x{{01}})+{WS}*', {node}, 'g')"
    expr = ustrip_sql(f"regexp_replace({ustrip_sql(expr)}, '\\A\\x{{01}}+|\\x{{01}}+\\z', '', 'g')")
    return f"replace({expr}, {node}, '{sep}')"
