"""Fixed values.

Everything in the first block must equal what the original Q&A preparation
scripts use, so results line up token for token.  They are stated plainly and
in their natural order; code elsewhere only reads them.
"""

from __future__ import annotations

# --- fixed values (must match the original preparation scripts) -------------

START_TOKEN = "<start>"
UNK_TOKEN = "<unkonw>"  # sic: the original spelling is part of the data format
END_TOKEN = "<end>"
PAD_TOKEN = "<pad>"

# Punctuation tagging, applied after lower-casing, in this order.  The second
# "?" rule of the original is dead (the first already replaced every "?").
PUNCTUATION_TAGS = [
    (".", "<PERIOD>"),
    ("。", "<PERIOD>"),
    (",", "<COMMA>"),
    ("，", "<COMMA> "),
    ('"', "<QUOTATION_MARK>"),
    (";", "<SEMICOLON>"),
    ("!", "<EXCLAMATION_MARK>"),
    ("?", "<QUESTION_MARK>"),
    ("(", "<LEFT_PAREN>"),
    (")", "<RIGHT_PAREN>"),
    ("--", "<HYPHENS>"),
    (":", "<COLON>"),
]

# Sentence cleaning deletes runs of these characters ...
CLEAN_CHARS = "+-|!/[]{}_,.$%^*(\"')" + ":：—【】“”！，。？、~@#￥…&（）?"
# ... plus every character Python's ``\s`` matches (29 code points) ...
CLEAN_WHITESPACE = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# ... and each of these literals, all in a single left-to-right pass.
CLEAN_LITERALS = ["车主说", "技师说", "语音", "图片", "你好", "您好"]

# Speaker labels that prefix the turns of a dialogue cell, and the turn joiner.
OWNER_LABEL = "车主说："
TECHNICIAN_LABEL = "技师说："
TURN_SEPARATOR = "|"

# Original defaults: embedding config and skip-gram trainer settings.
WV_SIZE = 200
WV_WINDOW = 3
WV_MIN_COUNT = 5
SG_SIZE = 300
SG_BATCH = 100
SG_WINDOW = 3
SG_EPOCHS = 10
SG_NEGATIVES = 1000
SUBSAMPLE_TH = 0.8
SUBSAMPLE_T = 0.001
RARE_WORD_CUT = 5
CONTEXT_WINDOW_DEFAULT = 5

# --- our own choices ---------------------------------------------------------

# Regex word segmentation: a token is a maximal run of letters and digits ...
RUN_PATTERN = r"[\p{L}\p{N}]+"
# ... and in text whose punctuation was tagged, a whole tag is a token too.
TOKEN_PATTERN = r"<[A-Z]+(?:_[A-Z]+)*>|" + RUN_PATTERN

# Stopwords for the four languages of the driver corpus (the original ships its
# stopword file separately; this list is ours).
DEFAULT_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is",
    "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "au", "aux", "de", "des", "du", "en", "et", "la", "le", "les", "un", "une",
    "das", "dem", "den", "der", "die", "ein", "eine", "und", "zu",
    "el", "los", "las", "y", "que", "con", "por",
]


def _escape(code_point: int) -> str:
    return "\\x{%x}" % code_point


def clean_pattern() -> str:
    """The cleaning regex, written so Java (Spark) and RE2 (DuckDB) read it alike."""
    chars = "".join(_escape(ord(c)) for c in dict.fromkeys(CLEAN_CHARS))
    chars += "".join(_escape(c) for c in CLEAN_WHITESPACE)
    return "[" + chars + "]+|" + "|".join(CLEAN_LITERALS)
