"""Pipeline defaults.

The first block holds fixed values that decide the results; the second only
decides how the work is spread.
"""

# Fixed values of the search-log job.
EMPTY_QUERY = "-"
BOT_USERS = (71845,)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SESSION_SPAN_S = 600
TOP_REFINEMENTS = 80
TOP_DOCS = 15
MIN_CLUSTERS = 20
EPSILON = 0.6
DOUBLINGS = 4
MIN_FIELD_COUNT = 1000
SUGGESTION_LIMIT = 1000

# Pairs of a record and a session start that one task makes for one user and slot.
PAIRS_PER_TASK = 500_000
# Shuffle partitions of the hot slots; more parts of slots share them.
CELLS_AT_MOST = 4_000
# Refinements of one query that are handled as a full matrix; more are refused.
MAX_REFINEMENTS = 2000
# Document rows of one query handled by one clustering task.
DOC_ROWS_PER_TASK = 50_000
# Entries of absorption vectors that one task forms, and that one task multiplies.
ENTRIES_PER_TASK = 1_000_000
VECTOR_ROWS_PER_TASK = 200_000
# Folders of a suggestion table that is replaced by query.
SUGGESTION_BUCKETS = 256
# Similarities that agree to this many significant digits count as equal.
SIMILARITY_DIGITS = 12
# How much later than the latest record of a stream a record may arrive.
STREAM_DELAY = "1 hour"
# Most buckets that the first pass of field counts may use; as many numbers are broadcast.
FIELD_BUCKETS_AT_MOST = 1 << 22
