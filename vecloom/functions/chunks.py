"""Overlapping character windows as array expressions.

Windows start at 0, step, 2*step, ... below the text length, where step = max(1, size - overlap). A tail that
lies wholly inside the window before it is still a window.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecloom import constants as C

# substring() walks the text from its start, so windows of a text cost length**2 / step. Beyond this length the
# text is first cut into step-sized pieces in one linear pass and windows are joined from neighbouring pieces.
LINEAR_BEYOND = 32_768


def step_of(size: int, overlap: int) -> int:
    return max(1, size - overlap)


def window_count(text: Column, size: int, overlap: int) -> Column:
    return F.ceil(F.length(text) / F.lit(step_of(size, overlap))).cast("int")


def _by_substring(text: Column, size: int, step: int) -> Column:
    starts = F.sequence(F.lit(0), F.length(text) - 1, F.lit(step))
    return F.transform(starts, lambda start: F.substring(text, start + 1, F.lit(size)))


def _by_pieces(text: Column, size: int, step: int) -> Column:
    spanned = -(-size // step)

    def joined(pieces: Column) -> Column:
        return F.transform(
            pieces, lambda _, i: F.left(F.array_join(F.slice(pieces, i + 1, F.lit(spanned)), ""), F.lit(size))
        )

    # The outer one-element array makes the pieces a lambda variable: cut once per text, not once per window.
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % step), F.lit(0))
    return F.element_at(F.transform(F.array(cut), joined), 1)


def windows(
    text: Column, size: int = C.CORPUS_CHUNK_SIZE, overlap: int = C.CORPUS_CHUNK_OVERLAP, max_length: int | None = None
) -> Column:
    """array<string> of windows; empty for null or empty text.

    ``max_length`` is a bound the caller has already enforced on the text.
    """
    step = step_of(size, overlap)
    none = F.array().cast("array<string>")
    if max_length is not None and max_length <= LINEAR_BEYOND:
        return F.when(F.length(text) > 0, _by_substring(text, size, step)).otherwise(none)
    return (
        F.when(F.length(text) > LINEAR_BEYOND, _by_pieces(text, size, step))
        .when(F.length(text) > 0, _by_substring(text, size, step))
        .otherwise(none)
    )


def window_start(index: Column, size: int, overlap: int) -> Column:
    return (index * F.lit(step_of(size, overlap))).cast("int")


def window_end(index: Column, length: Column, size: int, overlap: int) -> Column:
    return F.least(window_start(index, size, overlap) + F.lit(size), length).cast("int")


def heading_path() -> Column:
    return F.array(F.lit(C.HEADING_PATH))
