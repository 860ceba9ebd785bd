"""Sizes, defaults and names that callers rely on.

The first group holds fixed values: changing one changes results or rejects
input that used to load.
"""

# --- fixed values -----------------------------------------------------------
DEFAULT_BATCH_SIZE = 500
MAX_BATCH_VECTORS = 4_194_304
MAX_VECTOR_DIM = 16_384
MAX_ID_BYTES = 4_096
MAX_QUERY_BATCH = 65_536
MAX_FILE_DIM = 100_000
DEFAULT_TOP_K = 10
DEFAULT_STORE_K = 4
DEFAULT_TENANT = "t_demo"
DEFAULT_SEGMENT = "warm.default"
DEFAULT_EVENT_TYPE = "observation"
DEFAULT_WINDOW_FROM = "1970-01-01 00:00:00"
DEFAULT_WINDOW_TO = "2099-12-31 23:59:59"
INDEX_TYPES = ("DISKANN", "HNSW", "IVF_FLAT", "IVF_PQ", "IVF_SQ8")
DEFAULT_INDEX_TYPE = "HNSW"
DEFAULT_METRIC = "COSINE"
EMBED_BATCH = 32
TEXT_VECTOR_DIM = 256
ERRORS_SHOWN = 5

# --- our own choices for computations that are only named, not fixed --------
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
RRF_CONSTANT = 60
SUMMARY_SENTENCES = 3
HALF_LIFE_DAYS = 30
STALE_AFTER_DAYS = 30
CONTEXT_EVENTS = 10
PQ_PARTS = 8
PQ_BITS = 4
PQ_RERANK = 4

# --- physical bounds --------------------------------------------------------
BROADCAST_BYTES = 256 * 1024 * 1024   # largest query or centroid matrix sent to every executor
BASE_BLOCK_BYTES = 32 * 1024 * 1024   # base vectors of one search block
QUERY_BLOCK_BYTES = 16 * 1024 * 1024  # query vectors of one search block
SCORE_CELLS = 4_000_000               # scores held at once inside a task
SCORE_ROWS = 8_192                    # base rows compared at once
FIRST_ROWS = 1_024                    # base rows scored in full before others are screened
SCREEN_ROWS = 512                     # queries, and base rows, screened at once: their products fit a core's cache
SCREEN_SHARE = 1 / 8                  # pairs scored singly at most, of those screened; else all are scored
SEARCH_TASKS = 10_000                 # tasks of one search at most
KEPT_ROWS = 2_000_000                 # best rows a task holds, all queries and groups together
SHARED_KEPT_ROWS = 500_000            # best rows a task holds where every task compares all queries
LEAST_QUERY_ROWS = 256                # queries compared at once, however much each keeps

# diversified search: rows returned, rows fetched, weight of nearness against novelty
MMR_K, MMR_FETCH, MMR_WEIGHT = 4, 20, 0.5
AGENT_SKETCH_BITS = 12  # estimates of distinct agents are off by about 1.6 %
SIZE_SKETCH_K = 200     # ranks of estimated quantiles are off by about 1 %
