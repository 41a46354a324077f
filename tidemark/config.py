"""Default numbers of the retrieval engine. Results depend on them."""

CHUNK_TOKENS = 504
CHUNK_OVERLAP = 0.15
MIN_CHUNK_TOKENS = 10
TABULAR_CHUNKS = 400
CANDIDATES = 200
RRF_K0 = 60
BOOST = 1.05
PER_DOC = 3
TOP_FRAGMENTS = 10
TOP_DOCUMENTS = 3
FRAGMENT_WORDS = 250
POOL_DEPTH = 15
AGGREGATION = "top2"
OCR_MIN_CHARS = 200
MATCH_THRESHOLD = 0.55
GRAM = 5
TOKEN_MARGIN = 8
BLOCK_ROWS = 2048
GRAPH_MIN_DF = 2
GRAPH_MAX_DF_SHARE = 0.05
GRAPH_PER_CHUNK = 12
GRAPH_NEIGHBOUR = 0.35
GRAPH_CANDIDATES = 50
TAU_DIGITS = 9  # similarities and scores are rounded to this before they are ranked
