"""Column builders for text cleaning, identity and rendering. All stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecloom import constants as C


def strip(text: Column) -> Column:
    """Trim the Unicode white space Python's ``str.strip`` trims. Touches only the ends of the text."""
    return F.btrim(text, F.lit(C.WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text) == "", F.lit(True))


def in_length_band(stripped: Column, low: int = C.MIN_CHARS, high: int = C.MAX_CHARS) -> Column:
    """True for texts of low..high characters; false, never null, otherwise."""
    return F.coalesce(F.length(stripped).between(low, high), F.lit(False))


def default_url(url: Column, file_name: Column, row_index: Column) -> Column:
    made = F.concat(F.lit(C.DEFAULT_URL_PREFIX), file_name, F.lit("-"), row_index.cast("string"))
    return F.coalesce(F.nullif(url, F.lit("")), made)


def is_valid_url(url: Column) -> Column:
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def doc_ref(sha1: Column) -> Column:
    return F.concat(F.lit(C.DOC_REF_PREFIX), F.left(sha1, F.lit(C.DOC_REF_DIGITS)))


def clean_markdown(md: Column) -> Column:
    """Unix line ends, no images, links replaced by their labels, no bare URLs, stripped. The order matters."""
    out = F.replace(F.replace(md, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    out = F.regexp_replace(out, C.MARKDOWN_IMAGE, "")
    out = F.regexp_replace(out, C.MARKDOWN_LINK, "$1")
    out = F.regexp_replace(out, C.BARE_URL, "")
    return strip(out)


def markdown_title(cleaned: Column) -> Column:
    """First level-one heading of cleaned markdown, or null."""
    return F.nullif(strip(F.regexp_extract(cleaned, C.LEVEL_ONE_HEADING, 1)), F.lit(""))


def snippet(text: Column, chars: int = C.SNIPPET_CHARS) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.left(text, F.lit(chars)), F.lit("..."))).otherwise(text)


def shown_score(score: Column) -> Column:
    return F.round(score, C.SCORE_DIGITS_SHOWN)


def human_bytes(size: Column) -> Column:
    """Size with one decimal in powers of 1024, ending at TB; a tie goes to the even tenth. Whole numbers only are used."""
    size = size.cast("bigint")
    last = len(C.BYTE_UNITS) - 1
    shown = _in_unit(size, last)
    for power in range(last - 1, -1, -1):
        shown = F.when(size < F.lit(1024 ** (power + 1)), _in_unit(size, power)).otherwise(shown)
    return shown


def _in_unit(size: Column, power: int) -> Column:
    unit, bits = 1024**power, 10 * power
    tenths = size.bitwiseAND(F.lit(unit - 1)) * 10  # of the rest, in units of 1 / unit
    tenth, rest = F.shiftright(tenths, bits), tenths.bitwiseAND(F.lit(unit - 1)) * 2
    up = (rest > unit) | ((rest == unit) & (tenth % 2 == 1))
    rounded = F.shiftright(size, bits) * 10 + tenth + F.when(up, 1).otherwise(0)
    whole = (rounded - rounded % 10) / 10
    return F.concat(whole.cast("bigint").cast("string"), F.lit("."), (rounded % 10).cast("string"), F.lit(C.BYTE_UNITS[power]))


def external_id_16() -> Column:
    """A random id of 16 hexadecimal digits."""
    return F.left(F.replace(F.uuid(), F.lit("-"), F.lit("")), F.lit(16))


def shown_time(ts: Column) -> Column:
    return F.date_format(ts, C.TIMESTAMP_FORMAT)


def metadata_line(vec_id: Column, url: Column, created_at: Column) -> Column:
    """One JSON line; a missing url is written as null."""
    record = F.struct(vec_id.alias("id"), url.alias("url"), created_at.alias("created_at"))
    return F.to_json(record, {"ignoreNullFields": "false"})
