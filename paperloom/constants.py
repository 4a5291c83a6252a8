"""Values that results depend on, kept in one place."""

# --- fixed values -----------------------------------------------------------
# Last path segments of a URL that say nothing about the document behind it.
UNHELPFUL_NAMES = ("view", "download", "file", "index", "blob", "raw")
MIN_NAME_CHARS = 3
NAME_DIGEST_CHARS = 10

# Characters Python's str.split() and str.strip() treat as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

DEFAULT_INSTRUCTION = "Retrieve relevant passages:"
SUBSET_INSTRUCTION = (
    "Generate embeddings that capture the core meaning of user-assistant conversations, "
    "ensuring the embeddings can be clustered based on semantic similarity for subset selection."
)
ENCODER_BATCH_SIZE = 24

DEFAULT_FOLDS = 50
DEFAULT_SEED = 42
MAX_EPSILON = 160.0
SMALL_DATASET_ROWS = 100_000
SMALL_DATASET_EPSILON = 1.0
COMBINED_DATASET_NAME = "combined_dataset"

CHUNK_TOKENS = 1024
COLLECTION_TEXT_CHARS = 65_535
COLLECTION_ID_CHARS = 256
COLLECTION_SOURCE_CHARS = 1024
HIT_PREVIEW_CHARS = 1000
HIT_SOURCE_CHARS = 60
CHUNK_PREVIEW_CHARS = 200
RBF_WIDTH = 0.1
IVF_CELLS = 128

IMAGE_MODES = ("embedded", "placeholder", "referenced")
SIMILARITY_METRICS = ("cosine", "dot", "euclidean", "rbf")
SIMILARITY_SCALINGS = ("min-max", "additive")
CONFIDENCE_GRADES = ("poor", "fair", "good", "excellent", "unspecified")
# --- end of fixed values ----------------------------------------------------

# The white space as a regular-expression class that Java and RE2 read the same way.
SPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in SPACES) + "]"

# Own choices: sizes that bound what one task or the driver may hold.
BLOCK_VECTORS = 10_000
BLOCK_BYTES = 64 * 1024 * 1024
# Blocks that one plan may broadcast.
ROUND_BLOCKS = 8
HASH_DIM = 256
# Rows of a fold that one task may hold the vectors of.
MAX_FOLD_ROWS = 200_000
# The largest prime below 2 ** 31: products of two codes fit 64 bits.
SAMPLE_PRIME = 2_147_483_647
NORM_FLOOR = 1e-12
