"""Text helpers shared by the cleaning expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemart.config import PY_WHITESPACE_CLASS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Trim the whitespace Python's ``str.strip()`` trims (Spark ``trim`` only trims spaces)."""
    ws = PY_WHITESPACE_CLASS
    # the lookahead passes plain characters at once; the class has many ranges
    return F.regexp_replace(_c(c), f"^{ws}+|(?![!-~]){ws}+$", "")


def normalise_label(c) -> Column:
    """Label snake-case: spaces to underscores, then upper case."""
    return F.upper(F.replace(_c(c), F.lit(" "), F.lit("_")))


# Named character references decoded in cell text (``&amp;`` is decoded last).
HTML_SPACES = (("nbsp", "\u00a0"), ("ensp", "\u2002"), ("emsp", "\u2003"), ("thinsp", "\u2009"), ("Tab", "\t"), ("NewLine", "\n"))
HTML_ENTITIES = (
    ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("ndash", "\u2013"), ("mdash", "\u2014"), ("minus", "\u2212"),
    ("hyphen", "\u2010"), ("lsquo", "\u2018"), ("rsquo", "\u2019"), ("ldquo", "\u201c"), ("rdquo", "\u201d"),
    ("hellip", "\u2026"), ("bull", "\u2022"), ("middot", "\u00b7"), ("euro", "\u20ac"), ("pound", "\u00a3"), ("yen", "\u00a5"),
    ("cent", "\u00a2"), ("curren", "\u00a4"), ("copy", "\u00a9"), ("reg", "\u00ae"), ("trade", "\u2122"), ("deg", "\u00b0"),
    ("plusmn", "\u00b1"), ("times", "\u00d7"), ("divide", "\u00f7"), ("frac12", "\u00bd"), ("frac14", "\u00bc"),
    ("frac34", "\u00be"), ("num", "#"), ("dollar", "$"), ("percnt", "%"), ("comma", ","), ("period", "."), ("colon", ":"),
    ("sol", "/"), ("lpar", "("), ("rpar", ")"), ("plus", "+"),
)
# Numeric references 128 to 159 that stand for other characters.
HTML_OLD_CODES = {128: 0x20AC, 130: 0x201A, 131: 0x192, 132: 0x201E, 133: 0x2026, 134: 0x2020, 135: 0x2021, 136: 0x2C6, 137: 0x2030,
                  138: 0x160, 139: 0x2039, 140: 0x152, 142: 0x17D, 145: 0x2018, 146: 0x2019, 147: 0x201C, 148: 0x201D, 149: 0x2022,
                  150: 0x2013, 151: 0x2014, 152: 0x2DC, 153: 0x2122, 154: 0x161, 155: 0x203A, 156: 0x153, 158: 0x17E, 159: 0x178}
# All other names that HTML 5 defines, from Python's own table; looked up only where a text holds such a reference.
_OTHER_NAMES = {n[:-1]: ch for n, ch in html5.items() if n.endswith(";") and n != "amp;"}
_SPACE_CODES = (9, 10, 11, 12, 13, 32, 160, 0x2002, 0x2003, 0x2009)


def _numeric(code: int) -> str:
    """Pattern of the decimal and hexadecimal references of a character."""
    hexa = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in f"{code:x}")
    return f"&#(?:0*{code}|[xX]0*{hexa});"


def _let(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _if_references(c: Column, decode) -> Column:
    """``decode`` of a text that may hold references; other texts pass as they are."""
    return _let(c, lambda x: F.when(F.contains(x, F.lit("&")), decode(x)).otherwise(x))


def _decode_spaces(c: Column) -> Column:
    """White space written as references, decoded (it has to be there before texts are stripped)."""
    def decode(x):
        for name, ch in HTML_SPACES:
            x = F.replace(x, F.lit(f"&{name};"), F.lit(ch))
        return _let(x, lambda t: F.when(F.rlike(t, F.lit("|".join(map(_numeric, _SPACE_CODES)))), numeric(t)).otherwise(t))

    def numeric(x):
        for code in _SPACE_CODES:
            x = F.regexp_replace(x, _numeric(code), chr(code))
        return x
    return _if_references(c, decode)


def _character(ref: Column) -> Column:
    """The character of a numeric reference's inside (``45`` or ``x2D``); U+FFFD for one that is none."""
    old = F.create_map(*[F.lit(x).cast("long") for kv in HTML_OLD_CODES.items() for x in kv])
    number = lambda r: F.when(F.lower(F.substring(r, 1, 1)) == "x", F.conv(F.substring(r, 2, 8), 16, 10)).otherwise(
        F.substring(r, 1, 10)).try_cast("long")
    good = lambda n: (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    char = lambda n: F.when(good(n), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("\ufffd")
    return _let(_let(_let(ref, number), lambda n: F.coalesce(F.element_at(old, n), n)), char)


def _decode_entities(c: Column) -> Column:
    """Every other reference decoded, ``&amp;`` last."""
    def rejoined(pieces):       # pieces after each "&#" start with the digits and the semicolon
        rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: F.concat(
            _character(F.substring_index(x, ";", 1)), F.substring(x, F.instr(x, ";") + 1, F.length(x))))
        return F.concat(F.get(pieces, 0), F.array_join(rest, ""))

    def named(pieces):          # pieces after each "&" start with a name and the semicolon
        table = F.create_map(*[F.lit(t) for kv in _OTHER_NAMES.items() for t in kv])
        rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: _let(
            F.substring_index(x, ";", 1), lambda name: F.coalesce(
                F.concat(F.element_at(table, name), F.substring(x, F.length(name) + 2, F.length(x))), F.concat(F.lit("&"), x))))
        return F.concat(F.get(pieces, 0), F.array_join(rest, ""))

    def names(x):
        for name, ch in HTML_ENTITIES:
            x = F.replace(x, F.lit(f"&{name};"), F.lit(ch))
        other = r"&(?!amp;)(?=[A-Za-z][A-Za-z0-9]*;)"
        return _let(x, lambda t: F.when(F.rlike(t, F.lit(other)), _let(F.split(t, other), named)).otherwise(t))

    def decode(x):
        x = _let(F.when(F.rlike(x, F.lit("&[A-Za-z]")), names(x)).otherwise(x), lambda t: F.when(
            F.contains(t, F.lit("&#")), _let(F.split(t, r"&#(?=(?:[0-9]+|[xX][0-9A-Fa-f]+);)"), rejoined)).otherwise(t))
        return F.replace(x, F.lit("&amp;"), F.lit("&"))
    return _if_references(c, decode)


def visible(c) -> Column:
    """HTML without what a reader never sees: comments, scripts and styles."""
    return F.regexp_replace(_c(c), r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)", "")


def cell_text(c) -> Column:
    """Text of an HTML cell like a stripped-strings join: every text node stripped, then
    concatenated without a gap.  Text nodes are bounded by tags, so removing each tag
    together with the whitespace touching it strips every node; references to white space are
    decoded before, the other references after (so ``&lt;b&gt;`` stays text)."""
    ws = PY_WHITESPACE_CLASS

    def untagged(x):        # the lookahead as in py_strip
        return F.regexp_replace(x, f"(?![!-;=-~]){ws}*+<(?:!--.*?-->|[^>]*+>){ws}*+", "")
    x = _c(c)
    # most cells hold no reference: they need none of the lambdas, which Spark doesn't compile
    return F.when(F.contains(x, F.lit("&")), py_strip(_decode_entities(untagged(_decode_spaces(x))))).otherwise(py_strip(untagged(x)))


def spaced_text(c) -> Column:
    """Text of an HTML fragment with every tag replaced by a space (for keyword tests)."""
    return _decode_entities(_decode_spaces(F.regexp_replace(_c(c), "<!--.*?-->|<[^>]*>", " ")))
