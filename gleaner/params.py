"""Run parameters and the fixed values they default to."""

from __future__ import annotations

from dataclasses import dataclass

# Results only match when these are exactly as listed.
RELEVANT_KEYWORDS = (
    "rag",
    "retrieval augmented generation",
    "retrieval",
    "llm",
    "language models",
    "context engineering",
    "context windows",
    "embedding",
    "vector search",
    "semantic search",
    "prompt engineering",
    "fine-tuning",
    "transformer",
    "attention mechanisms",
    "chain of thought",
    "reasoning",
    "re-ranking",
    "inference",
    "knowledge graphs",
    "instruction following",
    "co-reference resolution",
    "langchain",
    "llamaindex",
    "context rot",
    "agent architecture",
    "agent scaffolding",
    "context compaction",
    "sub-agents",
    "reduce context",
    "offload context",
    "agent memory",
    "context poisoning",
    "context distraction",
    "context confusion",
    "context clash",
    "contextual ai",
    "contextual retrieval",
    "agentic",
    "tool use",
    "hallucination",
    "chunking",
    "MCP",
    "hybrid search",
    "grounding",
    "long context",
    "reranker",
    "reranking",
    "orchestration",
    "tool calling",
    "function calling",
    "tool selection",
    "tool integration",
)

# Substrings of URLs that are never articles.
EXCLUDE_PATTERNS = (
    "/careers",
    "/jobs",
    "/pricing",
    "/terms",
    "/privacy",
    "/login",
    "/signup",
)

# Regular expressions on the raw href of a listing link.
SKIP_LINK_PATTERNS = (
    r"^/?$",
    r"/tag/",
    r"/category/",
    r"/author/",
    r"/page/\d+",
    r"/search",
    r"/about",
    r"/contact",
    r"/products",
    r"/solutions",
    r"/platform",
    r"/company",
    r"/docs",
    r"/api",
    r"\.(jpg|png|gif|pdf|css|js)$",
)

# Limits and delays.
MIN_WORDS = 200
MAX_WORDS = 50_000
LOOKBACK_DAYS = 60
MAX_PER_SOURCE = 50
MIN_PAGE_CHARS = 200
SHORT_ENTRY_CHARS = 200
SUMMARY_CHARS = 500
WORDS_PER_MINUTE = 200
DEFAULT_DELAY_SECONDS = 2.0
RETRY_BASE_SECONDS = 1.0
RETRY_FACTOR = 2.0
RETRY_MAX_SECONDS = 60.0
MAX_RETRIES = 3
FATAL_ERRORS = ("KeyboardInterrupt", "SystemExit")
LEXICAL_WEIGHT = 0.2
SEMANTIC_WEIGHT = 0.8
TOP_K = 50
RERANK_TOP_K = 15
RERANK_THRESHOLD = 0.2


@dataclass(frozen=True)
class FilterParams:
    """What an article must satisfy to be kept.

    ``lookback_days`` of 0 or None switches the date test off, an empty
    ``keywords`` the keyword test; ``max_words`` of None means no upper end.
    """

    lookback_days: int | None = LOOKBACK_DAYS
    min_words: int = MIN_WORDS
    max_words: int | None = MAX_WORDS
    keywords: tuple[str, ...] = RELEVANT_KEYWORDS
    exclude_patterns: tuple[str, ...] = EXCLUDE_PATTERNS


@dataclass(frozen=True)
class RunParams:
    """One run. ``as_of`` is an ISO instant and replaces the wall clock."""

    as_of: str
    max_per_source: int = MAX_PER_SOURCE
    force_rescrape: bool = False
    dry_run: bool = False
    filters: FilterParams = FilterParams()

    def __post_init__(self):
        if self.max_per_source < 1:
            raise ValueError("max_per_source must be at least 1")
