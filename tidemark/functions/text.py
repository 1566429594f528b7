"""String functions on columns. All but the sentences are built-in expressions, so they stay inside code generation;
scans of whole texts that Java's patterns are slow at are in ``scans``.

Patterns carry ``(?U)`` where white space or word characters of all scripts are meant: Java's classes are
ASCII by default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import scans

# Patterns of the marks of sentences that a chunk border cut and of text outside speech, English
# abbreviations that end in a stop, and the ranges of full-width characters and of Chinese ideographs.
STITCH = "(?s)【延伸句】.*?[.?!。]|【承接句】.*?(?:[.?!。]|(?=\\n)|$)"
STITCH_PREFIX = "【(?:承接句|延伸句)】"
BRACKETED = r"\[[^\]]*\]"
ABBREVIATIONS = "Mr Mrs Ms Dr Prof Rev St Sr Jr vs etc al Inc Ltd Corp Co Dept Fig Eq No Vol e\\.g i\\.e approx min max hr sec Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec".split()
CJK = "\\x{2e80}-\\x{9fff}\\x{ac00}-\\x{d7af}\\x{3040}-\\x{30ff}\\x{f900}-\\x{faff}\\x{ff00}-\\x{ffef}"
HAN = "\\x{4e00}-\\x{9fff}"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_brackets(c: Column) -> Column:
    return F.regexp_replace(c, BRACKETED, "")


def is_pure_marker(c: Column) -> Column:
    """Nothing visible is left without [bracketed] marks."""
    return strip(strip_brackets(c)) == ""


def strip_stitch_marks(c: Column) -> Column:
    """Without border marks and the text that completes them."""
    return F.regexp_replace(c, STITCH, "")


def strip_stitch_prefix(c: Column) -> Column:
    """Without border marks, their text kept."""
    return F.regexp_replace(c, STITCH_PREFIX, "")


def residual_marks(c: Column) -> Column:
    """Border marks left in a text."""
    return F.regexp_extract_all(c, F.lit("(【(?:承接句|延伸句)】)"), 1)


def count_of(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch)))


def bracket_state(c: Column) -> Column:
    """'bracket' if （） or () are out of balance, else 'ok'."""
    return F.when((count_of(c, "（") != count_of(c, "）")) | (count_of(c, "(") != count_of(c, ")")), "bracket").otherwise("ok")


def quote_state(c: Column) -> Column:
    """'quote' if “” are out of balance or plain quotes are odd, else 'ok'."""
    return F.when((count_of(c, "“") != count_of(c, "”")) | (count_of(c, '"') % 2 != 0), "quote").otherwise("ok")


def text_width(c: Column) -> Column:
    """Display width: ASCII letters, digits and the space are half, everything else is one."""
    half = F.length(F.regexp_replace(c, "[^A-Za-z0-9 ]", ""))
    return F.length(c).cast("double") - F.lit(0.5).cast("double") * half


def width_flag(width: Column, soft: float = 22, hard: float = 26) -> Column:
    return F.when(width > hard, "ERROR").when(width > soft, "WARN").otherwise("ok")


FOLD_FROM, FOLD_TO = scans.folds()


def norm(c: Column) -> Column:
    """Letters without marks, lower-cased; only a-z, 0-9 and the apostrophe stay."""
    folded = F.when(F.octet_length(c) > F.length(c), F.translate(c, FOLD_FROM, FOLD_TO)).otherwise(c)  # plain ASCII has no marks
    return F.regexp_replace(F.lower(folded), "[^a-z0-9']+", "")


def norm_ascii(c: Column) -> Column:
    """Like ``norm`` without folding marks: marked letters go."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9']+", "")


def norm_offsets(c: Column) -> Column:
    """0-based places of the characters that ``norm_ascii`` keeps."""
    chars = F.filter(F.split(F.lower(c), ""), lambda x: x != "")
    placed = F.transform(chars, lambda x, i: F.when(x.rlike("^[a-z0-9']$"), i))
    return F.filter(placed, lambda i: i.isNotNull())


def zh_content(c: Column) -> Column:
    return F.regexp_replace(c, f"[^{HAN}0-9A-Za-z]", "")


def words(c: Column) -> Column:
    """Lower-case words [a-z0-9']+ in order."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9']+"), 0)


def sentences_en(c: Column) -> Column:
    """Sentences of collapsed text: a boundary follows [.!?]+ before a space or the end."""
    return scans.sentences_en(c)


def sentences_zh(c: Column) -> Column:
    """Sentences up to one of 。？！ each; the second of doubled marks is a piece of its own."""
    return scans.sentences_zh(c)


def sentences_subtitle(c: Column) -> Column:
    """Sentences of subtitle English: no boundary at an ellipsis, after an abbreviation, or before a lower-case
    letter that follows without a space."""
    text = strip_stitch_prefix(collapse(c))
    # Protected stops: their boundary mark is taken back.
    marked = F.regexp_replace(text, r"([.!?]+)", "$1\n")
    marked = F.regexp_replace(marked, r"([.!?]*\.\.\.[.!?]*)\n", "$1")
    marked = F.regexp_replace(marked, rf"((?i)(?<![A-Za-z])(?:{'|'.join(ABBREVIATIONS)})\.)\n", "$1")
    marked = F.regexp_replace(marked, r"(?U)\n(?=\p{Lower})", "")
    return F.filter(F.transform(F.split(marked, "\n"), strip), lambda s: s != "")


def collapse_mixed(c: Column) -> Column:
    """Folded lines joined: white space between two full-width characters goes, other runs become one space."""
    both = rf"(?U)(?<=[{CJK}])\s+(?=[{CJK}])"
    return strip(F.regexp_replace(F.regexp_replace(c, both, ""), r"(?U)\s+", " "))


def split_by_punct(c: Column, marks: str) -> Column:
    """Cut after any of ``marks``; pieces trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(c, f"(?<=[{marks}])"), strip), lambda s: s != "")


def split_levels(c: Column, levels: tuple[str, ...] = ("，；：", "、", "—"), hard: float = 26) -> Column:
    """Cut by each level's marks where a piece is wider than ``hard``; levels are fixed, so no recursion."""

    def cut(marks: str):  # a lambda's second parameter would be the place in the array
        return lambda s: F.when(text_width(s) <= hard, F.array(s)).otherwise(split_by_punct(s, marks))

    out = F.array(c)
    for marks in levels:
        out = F.flatten(F.transform(out, cut(marks)))
    return out


def split_terms(c: Column) -> Column:
    """Word forms of a glossary cell: split at ;, ``main (aka alias)`` is two, trailing * go."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), strip), lambda s: s != "")
    alias = r"(?i)^(.*?)\s*\((?:aka|aka\.)\s*(.*?)\)\s*$"
    both = F.flatten(F.transform(parts, lambda s: F.when(s.rlike(alias), F.array(F.regexp_extract(s, alias, 1), F.regexp_extract(s, alias, 2))).otherwise(F.array(s))))
    return F.filter(F.transform(both, lambda s: strip(F.regexp_replace(strip(s), r"\*+$", ""))), lambda s: s != "")


def term_forms(c: Column) -> Column:
    """Variants of a term: without parentheses, split at slashes and semicolons, with spaces and hyphens
    exchanged or dropped, and camel case taken apart; in order, without repeats."""
    bare = F.regexp_replace(c, r"[（(][^）)]*[）)]", "")
    forms = F.filter(F.transform(F.split(bare, "[/／;；]"), strip), lambda s: s != "")
    space, hyphen = F.lit(" "), F.lit("-")

    def variants(f: Column) -> Column:
        camel = F.regexp_replace(F.regexp_replace(f, r"(?<=[a-z0-9])(?=[A-Z])", " "), r"(?<=[A-Z])(?=[A-Z][a-z])", " ")
        more = [
            F.when(F.contains(f, space), F.replace(f, space)),
            F.when(F.contains(f, space), F.replace(f, space, hyphen)),
            F.when(F.contains(f, hyphen), F.replace(f, hyphen, space)),
            F.when(F.contains(f, hyphen), F.replace(f, hyphen)),
            F.when(~f.rlike(r"(?U)\s") & (camel != f), camel),
        ]
        return F.filter(F.array(f, *more), lambda x: x.isNotNull())

    return F.array_distinct(F.flatten(F.transform(forms, variants)))


def compact(c: Column) -> Column:
    return F.regexp_replace(c, "[ \\-\\x{2010}\\x{2011}]", "")


def quote_regex(c: Column) -> Column:
    """A column's text as a literal pattern."""
    return F.regexp_replace(c, r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")


def word_pattern(c: Column) -> Column:
    """Pattern of a form as a word of its own, with a plural ending allowed."""
    return F.concat(F.lit(r"(?iuU)\b"), quote_regex(c), F.lit(r"(?:es|s)?\b"))


def compact_pattern(c: Column) -> Column:
    return F.concat(F.lit("(?iu)(?<![a-zA-Z])"), quote_regex(compact(c)), F.lit("(?![a-zA-Z])"))


def translation_forms(c: Column) -> Column:
    bare = F.regexp_replace(c, r"[（(][^）)]*[）)]", "")
    return F.concat(F.array(c), F.filter(F.transform(F.split(bare, "[/／、;；]"), strip), lambda s: s != ""))


def norm_zh(c: Column) -> Column:
    return F.lower(F.replace(F.regexp_replace(c, r"(?U)\s+", ""), F.lit("的"), F.lit("")))


def clip(c: Column, n: int) -> Column:
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.left(c, F.lit(n)), F.lit("…")))


def line_at(c: Column, offset: Column) -> Column:
    """1-based line of a 0-based offset, clamped to the text."""
    at = F.greatest(F.lit(0), F.least(offset, F.length(c)))
    return F.size(F.split(F.substring(c, F.lit(1), at), "\n"))


def snippet_at(c: Column, offset: Column, radius: int = 55) -> Column:
    """The line around an offset, cut to ``radius`` characters on both sides with … where cut."""
    at = F.greatest(F.lit(0), F.least(offset, F.length(c)))
    line = F.element_at(F.split(c, "\n"), line_at(c, offset))
    before = F.substring(c, F.lit(1), at)
    rel = F.length(F.regexp_extract(before, r"(?s)([^\n]*)\z", 1))
    a, b = F.greatest(F.lit(0), rel - radius), F.least(F.length(line), rel + radius)
    return F.concat(F.when(a > 0, "…").otherwise(""), F.substring(line, a + 1, b - a), F.when(b < F.length(line), "…").otherwise(""))


def label_gid(c: Column) -> Column:
    """Group of a ``gid-片p`` label; a label without a part is its own group."""
    return F.when(c.rlike("^.+-片[0-9]+$"), F.regexp_extract(c, "^(.+)-片([0-9]+)$", 1)).otherwise(c)


def label_part(c: Column) -> Column:
    return F.when(c.rlike("^.+-片[0-9]+$"), F.regexp_extract(c, "^(.+)-片([0-9]+)$", 2).cast("int")).otherwise(F.lit(1))


def safe_name(c: Column) -> Column:
    return F.translate(c, "/\\ ", "___")


def render_template(template: Column, values: dict[str, Column]) -> Column:
    """Literal placeholders {name} replaced by columns."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def srt_record(idx: Column, start: Column, end: Column, body: Column, order: str = "en-zh") -> Column:
    """Tab record of a cue; two body lines are labelled by ``order``."""
    first, second = order.split("-")
    two = F.concat_ws("\t", F.concat(F.lit(f"{first}: "), body[0]), F.concat(F.lit(f"{second}: "), body[1]))
    text = F.when(F.size(body) == 2, two).otherwise(F.array_join(body, " | "))
    return F.concat_ws("\t", F.concat(F.lit("c"), idx.cast("string")), F.concat(start, F.lit(" --> "), end), text)


def hard_slices(c: Column, n: int) -> Column:
    """Fixed slices of ``n`` characters."""
    count = F.ceil(F.length(c) / n).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(c, i * n + 1, F.lit(n)))).otherwise(F.array().cast("array<string>"))
