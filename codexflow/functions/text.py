"""Text functions as column expressions: tokens, bigrams, digits, white space, escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The blocks that are cut into bigrams (kana, their extensions, ideographs, half-width kana).
CJK = r"\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9D}"
#: Full-width digits, and what stands for a hyphen in numbers.
WIDE_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
DASHES = "−ー―‐－"
#: Phrases of amendments in prose.
PROSE = ["に改める", "次のように改正する", "を加える", "を削る", "廃止する", "定める"]


def char_ngrams(text: Column, n: int = 2) -> Column:
    """Overlapping n-grams of code points, in order and with repeats; shorter texts give none."""
    size = F.length(text)
    return F.when(size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def tokens(text: Column) -> Column:
    """Search tokens in order, with repeats.

    A run of CJK characters gives its overlapping bigrams (a single one gives itself), any other run
    of letters and digits gives one token in lower case; everything else separates.
    """
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(rf"[{CJK}]+|[\p{{L}}\p{{N}}&&[^{CJK}]]+"), F.lit(0))
    # Most texts have no CJK character or are ASCII alone, and then a plainer pattern finds the same.
    other = F.transform(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.lower)
    ascii_ = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.when(F.octet_length(text) == F.length(text), ascii_).when(~text.rlike(f"[{CJK}]"), other).otherwise(F.flatten(F.transform(found, _of_run)))


def _of_run(run: Column) -> Column:
    return F.when(~run.rlike(rf"^[{CJK}]"), F.array(F.lower(run))).when(F.length(run) == 1, F.array(run)).otherwise(char_ngrams(run))


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case, without regard to script."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def bigram_jaccard(a: Column, b: Column) -> Column:
    """Share of distinct bigrams that both have; 0 if neither has one."""
    x, y = F.array_distinct(char_ngrams(a)), F.array_distinct(char_ngrams(b))
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def squeeze(text: Column) -> Column:
    """Every run of white space, the ideographic space included, becomes one space; ends are cut."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def narrow_digits(text: Column) -> Column:
    return F.translate(text, WIDE_DIGITS, DIGITS)


def digits_only(text: Column) -> Column:
    """Digits of either width; the character for a first year counts as 1."""
    return F.regexp_replace(narrow_digits(F.regexp_replace(text, "元", "1")), "[^0-9]", "")


def plain_number(text: Column) -> Column:
    """A circular's number: narrow digits, one kind of hyphen, neither blanks nor hyphens at the ends."""
    dashed = F.translate(narrow_digits(text), DASHES, "-" * len(DASHES))
    return F.regexp_replace(F.regexp_replace(dashed, r"(?U)\s+", ""), "^-+|-+$", "")


def escape_markup(text: Column, apostrophe: bool = True) -> Column:
    """Entities for the characters that XML reserves."""
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")] + [("'", "&apos;")] * apostrophe
    for character, entity in pairs:
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def context(text: Column, needle: str, before: int = 60, after: int = 100) -> Column:
    """Stretch around the first hit of ``needle`` without regard to case, with dots where it is cut."""
    at = F.instr(F.lower(text), needle.lower())
    begin = F.greatest(at - before, F.lit(1))
    stop = F.least(at + len(needle) - 1 + after, F.length(text))
    inside = F.substring(text, begin, stop - begin + 1)
    framed = F.concat(F.when(begin > 1, "…").otherwise(""), inside, F.when(stop < F.length(text), "…").otherwise(""))
    return F.when(at > 0, framed)


def after_mark(text: Column, mark: str = "／") -> Column:
    """What follows the first mark up to the next one; null if that is nothing."""
    return F.nullif(F.trim(F.coalesce(F.get(F.split(text, mark), F.lit(1)), F.lit(""))), F.lit(""))


def before_mark(text: Column, mark: str = "／") -> Column:
    return F.nullif(F.trim(F.get(F.split(text, mark), F.lit(0))), F.lit(""))


def short_ministry(text: Column) -> Column:
    """Up to and with the first character that ends the name of a ministry or agency."""
    return F.coalesce(F.nullif(F.regexp_extract(text, "^(.*?[省庁])", 1), F.lit("")), text)


def law_of_basis(text: Column) -> Column:
    """Name of the law in a legal basis: cut at the article number, then at a bracket or comma."""
    return F.nullif(F.trim(F.regexp_extract(squeeze(text), "^[^第（(、，　]+", 0)), F.lit(""))


def title_core(text: Column) -> Column:
    """A title without its last bracket, up to what says that it is amended, else to what says that it is abolished."""
    bare = F.regexp_replace(text, "（[^（]*$", "")
    before = lambda mark: F.when(F.contains(bare, F.lit(mark)), F.substring_index(bare, mark, 1))
    return F.regexp_replace(F.coalesce(before("の一部を"), before("を廃止"), bare), r"(?U)^\s+|\s+$", "")


def chamber(text: Column) -> Column:
    """Key of a chamber of the diet; other names stay."""
    return F.when(text == "衆議院", "shugiin").when(text == "参議院", "sangiin").when(text.isin("両院", "両議院"), "both").otherwise(text)


def drop_private_use(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x{E000}-\x{F8FF}]", "")


def amendment_format(text: Column) -> Column:
    """``shinkyu`` if both table headings stand alone on lines, ``prose`` by its phrases, else ``unknown``."""
    both = text.rlike(r"(?m)^\s*改正後\s*$") & text.rlike(r"(?m)^\s*改正前\s*$")
    prose = text.rlike("|".join(PROSE))
    return F.when(both, "shinkyu").when(prose, "prose").otherwise("unknown")


def is_amending_title(text: Column) -> Column:
    return text.contains("改正") | text.contains("廃止") | text.contains("制定")


def safe_name(text: Column, size: int = 24) -> Column:
    """The first characters with those that paths reserve replaced."""
    return F.translate(F.left(text, F.lit(size)), "/\\:\0", "____")


def own_law_articles(text: Column) -> Column:
    """Numbers of the articles of the law that a circular explains (``法第N条``), in narrow digits and in order;
    the name of another law before it makes it another law's article."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?:^|[^\x{4E00}-\x{9FFF}\x{3041}-\x{3093}\x{30A1}-\x{30F6}\x{30FC}\x{3005}])法第([0-9０-９]+)条"), F.lit(1))
    return F.transform(found, narrow_digits)
