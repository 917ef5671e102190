"""Fixed values.

Everything in this module must equal the values the archive tools use, or
results differ: date patterns, month names, start phrases, clean-up
replacements, truncation markers, section headers and placeholder texts.
They are stated here once, in their natural order, and every operator
reads them from here.

The date and header patterns are written in Python's dialect; ``regex.py``
turns ``\\s`` / ``\\d`` into explicit classes so that Spark (Java regex) and
the DuckDB oracle (RE2) both agree with Python's Unicode-aware classes.
"""

# Python's str.isspace() set, i.e. what ``\s`` and ``str.strip()`` accept:
# the Unicode White_Space characters plus the separators U+001C-U+001F.
# Java (Spark) names the property, which runs as fast as ``\s``; RE2 (the
# DuckDB oracle) has no such property, so it gets the explicit list.
WS = "\\p{IsWhite_Space}\\x1C-\\x1F"
WS_CLASS = "[" + WS + "]"
NON_WS_CLASS = "[^" + WS + "]"
WS_RE2 = (
    "\\t\\n\\x0B\\f\\r \\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
)
WS_CLASS_RE2 = "[" + WS_RE2 + "]"
NON_WS_CLASS_RE2 = "[^" + WS_RE2 + "]"

# ---------------------------------------------------------------- fixed values
# Date patterns, tried in this order (index = pattern number).  Patterns 1 and
# 3 need lower-case month letters but text is upper-cased first, so they never
# yield a date; pattern 5 reads the year as month and is always rejected.
DATE_PATTERNS = [
    r"MEETING\s+OF\s+([A-Z]+)\s+(\d{1,2}),?\s+(\d{4})",
    r"([A-Z][a-z]+)\s+(\d{1,2}),?\s+(\d{4})",
    r"([A-Z]+)\s+(\d{1,2}),?\s+(\d{4})",
    r"(\d{1,2})\s+([A-Z][a-z]+)\s+(\d{4})",
    r"(\d{1,2})/(\d{1,2})/(\d{4})",
    r"(\d{4})-(\d{1,2})-(\d{1,2})",
    r"MEETING.*?([A-Z]+)\s+(\d{1,2}),?\s+(19\d{2})",
    r"BOARD.*?EDUCATION.*?([A-Z]+)\s+(\d{1,2}),?\s+(19\d{2})",
]

# Month names (upper case, full and short forms).
MONTHS = {
    "JANUARY": 1, "JAN": 1,
    "FEBRUARY": 2, "FEB": 2,
    "MARCH": 3, "MAR": 3,
    "APRIL": 4, "APR": 4,
    "MAY": 5,
    "JUNE": 6, "JUN": 6,
    "JULY": 7, "JUL": 7,
    "AUGUST": 8, "AUG": 8,
    "SEPTEMBER": 9, "SEP": 9, "SEPT": 9,
    "OCTOBER": 10, "OCT": 10,
    "NOVEMBER": 11, "NOV": 11,
    "DECEMBER": 12, "DEC": 12,
}

# Meeting-start phrases (they overlap on purpose).
START_PHRASES = [
    "MEETING OF",
    "THE BOARD OF EDUCATION",
    "OKLAHOMA CITY, OKLAHOMA",
    "MET IN REGULAR SESSION",
    "MET IN ADJOURNED SESSION",
    "BOARD OF EDUCATION",
    "OKLAHOMA CITY",
]

# Page-evidence indicators: the start phrases, MEETING and the twelve months.
EVIDENCE_INDICATORS = START_PHRASES + [
    "MEETING",
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]

# OCR clean-up: literal fixes applied in this order after the regex steps.
OCR_FIXES = [
    (" tho ", " the "),
    (" ard ", " and "),
    (" mado ", " made "),
    (" soconded ", " seconded "),
    (" moeting ", " meeting "),
    (" minutos ", " minutes "),
]
# Punctuation kept by the clean-up (besides word characters and blanks).
KEPT_PUNCTUATION = ".,;:!?\\-()\\[\\]\"'/$%&@#"

# Length limits and truncation markers (each marker preceded by two newlines).
MAX_CHARS = 20000
MAX_PROMPT_CHARS = 15000
RETRY_CHARS = 8000
MARKER_LENGTH = "\n\n[TEXT TRUNCATED DUE TO LENGTH]"
MARKER_LONGER = "\n\n[TEXT TRUNCATED - DOCUMENT WAS LONGER]"

# Page marker around each non-blank page of an extracted document.
PAGE_MARKER = "\n--- Page {n} ---\n"

# Section headers of a summary reply, matched at the start of a stripped line,
# ignoring case, in this order.
SECTION_HEADERS = [
    ("synopsis", r"^\*?\*?synopsis\*?\*?:?"),
    ("summary", r"^\*?\*?summary\*?\*?:?"),
    ("key_notes", r"^\*?\*?key notes?\*?\*?:?"),
]
SECTION_DEFAULTS = {
    "synopsis": "No synopsis provided",
    "summary": "No summary provided",
    "key_notes": "No key notes provided",
}

# Placeholder records (synopsis, summary, key notes) per failure status.
PLACEHOLDERS = {
    "blank": ("No readable text found in PDF", "Unable to extract text content", "N/A"),
    "error": ("Error generating summary: {e}", "Unable to process due to API error", "N/A"),
    "too_long": (
        "Could not process - text too long: {e}",
        "Document too long for processing",
        "Unable to extract due to length",
    ),
}

# Roster header line of a transcript.
ROSTER_PREFIX = "Board Members: "
ROSTER_SEP = ", "

# Audio and token settings.
PART_SECONDS = 1800
TOKEN_CHUNK = 3000
WHOLE_BELOW_TOKENS = 7300
PACKED_CHUNK_TOKENS = 6000
SEP_AUDIO_FUSE = "\n\n---\n\n"
SEP_STRICT_FUSE = "\n\n"

# File naming.
MEETING_PDF_SUFFIX = "_meeting_minutes.pdf"
OCR_SUFFIX = "_ocr"
UNASSIGNED = "unassigned"
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".tiff", ".tif", ".bmp"]
# ------------------------------------------------------------ end fixed values
