"""Layout constants and tunables shared by all operators."""

from __future__ import annotations

# Fixed values of the index format (must stay as they are for identical layout):
# postings per compressed block, and the separators of the text formats.
POSTINGS_PER_BLOCK = 64
FIELD_SEP = " "       # between the term and its postings, and between postings
POSTING_SEP = ":"     # between doc id and term frequency inside one posting
COLLECTION_SEP = "\t"  # between doc id and passage in a collection line

# Runs of an ordered table: for each shuffle partition, the least rows of one,
# and the rows sampled for one.
RUNS_PER_PARTITION = 4
MIN_RUN_ROWS = 4096
SAMPLES_PER_RUN = 50
# Rows of one run, and of one task that sorts or groups postings: there are more
# runs and tasks for more rows.
TASK_ROWS = 1 << 19

# Stretches of lists, as documents are counted: postings that a task gathers by
# term at a time, and postings of one row at most.
LIST_TASK_POSTINGS = 1 << 20
LIST_POSTINGS = 1 << 14

# Postings in one line of the posting text format; a longer list becomes
# several lines of its term.
LINE_POSTINGS = 1 << 16

# A side is broadcast only if a count finds at most this many rows.
MAX_BROADCAST_ROWS = 100_000

# Query terms that go into a scan's filter as literals; more than Parquet's
# own limit for exact IN filters (10) prune by their range only.
MAX_LITERAL_TERMS = 10

# Borders that go into an expression as literals; more are searched in Python.
MAX_LITERAL_BORDERS = 32
