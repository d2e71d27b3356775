"""Values fixed by the file formats and results this package has to reproduce."""

# --- fixed values -----------------------------------------------------------
TEXT_COLUMNS = ["text", "content", "document", "page_content", "raw_content", "body", "clean_text", "html_text", "markdown"]
URL_COLUMNS = ["url", "source_url", "link", "origin", "canonical_url"]

MIN_CHARS = 80
MAX_CHARS = 8000

CORPUS_CHUNK_SIZE = 1000
CORPUS_CHUNK_OVERLAP = 100
DOCUMENT_CHUNK_SIZE = 1500
DOCUMENT_CHUNK_OVERLAP = 200

WHOLE_TEXT_LIMIT = 1000
WHOLE_TEXT_TYPE = "fineweb2"

DEFAULT_URL_PREFIX = "http://fw2.local/"
DOC_REF_PREFIX = "doc_"
DOC_REF_DIGITS = 12
HEADING_PATH = "# Loose"
DEFAULT_PAGE_TYPE = "service"
DEFAULT_LANGUAGE = "tr"
DEFAULT_TOP_K = 5
SNIPPET_CHARS = 200
SCORE_DIGITS_SHOWN = 4
CHECKPOINT_INTERVAL = "20 seconds"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]

# The 29 code points that Python's str.strip() and \s treat as white space.
WHITESPACE_POINTS = [
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x001C, 0x001D, 0x001E, 0x001F, 0x0020, 0x0085, 0x00A0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Markdown patterns in Java regex syntax. (?U) gives Unicode \s, which lacks only U+001C..1F.
MARKDOWN_IMAGE = r"!\[[^\]]*+\]\([^)]*+\)"
MARKDOWN_LINK = r"\[([^\]]++)\]\([^)]*+\)"
BARE_URL = r"(?U)https?://[^\s\x1c-\x1f]+"
LEVEL_ONE_HEADING = r"(?mdU)^#[\s\x1c-\x1f]+(.+)$"
# ----------------------------------------------------------------------------

WHITESPACE = "".join(map(chr, WHITESPACE_POINTS))

# Scores are float32 grade: rank order is taken on this many decimals, ties go to the smaller id.
SCORE_DIGITS = 6
