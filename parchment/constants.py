"""Fixed values that must equal the reference behaviour for equal results.

Kept together and in natural order.  Everything else is derived.
"""

# --- fixed values: text analysis -------------------------------------------
# Token pattern applied to lower-cased text (embedding and keyword analysis).
TOKEN_PATTERN = r"[a-z0-9][a-z0-9'-]*"
# Stop words removed before hashing features (and from keyword queries).
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in",
    "is", "it", "of", "on", "or", "that", "the", "this", "to", "with",
)

# --- fixed values: embedding -------------------------------------------------
EMBEDDING_DIMENSION = 128
EMBEDDING_MODEL = "local_hashing_v1"           # BLAKE2b-64 feature hash
SHA_EMBEDDING_MODEL = "local_hashing_sha_v1"   # SHA-256 feature hash (SQL-checkable)
UNIGRAM_WEIGHT = 1.0
BIGRAM_WEIGHT = 1.5
EMBEDDING_ROUND_DIGITS = 8

# --- fixed values: retrieval -------------------------------------------------
VECTOR_WEIGHT = 0.65
KEYWORD_WEIGHT = 0.35
KEYWORD_SCALE = 8.0
COVER_WEIGHT = 0.1          # weight of a default-class lexeme in cover density
RETRIEVAL_MODES = ("vector", "keyword", "hybrid")
HYBRID_PREVIEW_CHARS = 520
SEARCH_PREVIEW_CHARS = 360
DEFAULT_TOP_K = 5

# --- fixed values: pipeline defaults ----------------------------------------
EXTRACT_MIN_CHARACTERS = 500
DOCUMENT_MIN_CHARACTERS = 1000
DOCUMENT_MIN_WORDS = 150
CHUNK_WORDS = 220
OVERLAP_WORDS = 40
CHUNK_METHOD = "word_window"

# --- fixed values: reranker --------------------------------------------------
CANDIDATE_LIMIT = 40
RERANK_CANDIDATES = 20
TEST_SIZE = 0.25
VALIDATION_SIZE = 0.25
RANDOM_STATE = 99
GRID_C = (0.3, 1.0, 3.0)
GRID_NGRAM_MAX = (1, 2)
TFIDF_MAX_FEATURES = 8000
BLEND_WEIGHTS = tuple(w / 10 for w in range(0, 11))

# --- fixed values: domains (CHECK constraints) -------------------------------
SOURCE_TYPES = ("html", "pdf", "api", "csv", "rss", "other")
FETCH_METHODS = ("http_get", "api_query", "manual_seed")
REFRESH_POLICIES = ("daily", "weekly", "monthly", "manual")
SOURCE_STATUSES = ("not_started", "success", "unchanged", "failed", "quarantined", "disabled")
RUN_STATUSES = ("running", "success", "failed")
FETCH_STATUSES = ("success", "failed", "unchanged", "quarantined")
EXTRACTION_STATUSES = ("success", "failed", "quarantined")
DOCUMENT_STATUSES = ("candidate", "ai_ready", "quarantined")
SEVERITIES = ("info", "warning", "error")

# Whitespace as Python's str.split()/strip() understand it, written as a
# character class valid in both Java and RE2 regular expressions.
WS_CLASS = (r"[\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
            r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Line breaks as Python's str.splitlines() understands them.
LINE_BREAK = r"\r\n|[\n\x{0b}\x{0c}\r\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
