"""Table shapes and the fixed texts that stand in for missing values."""

from pyspark.sql import types as T

# The defaults written where a source has nothing.
NO_ABSTRACT = "No abstract available"
NO_TITLE = "No title available"
NO_ID = "No ID available"
UNKNOWN_ID = "unknown_id"
UNTITLED = "No Title"

# Direction of a neighbour as seen from the paper that was looked up.
CITATION = 0  # the neighbour cites the paper
REFERENCE = 1  # the paper cites the neighbour


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


PAPERS = _struct(
    ("id", T.LongType(), False),
    ("ss_id", T.StringType(), False),
    ("title", T.StringType(), False),
    ("abstract", T.StringType(), False),
    ("search_term", T.StringType(), True),
    ("num_hops", T.IntegerType(), True),
    ("url", T.StringType(), True),
    ("is_processed", T.BooleanType(), True),
)

# The place at which a look-up names a paper; the first one gives the paper its values.
PAYLOAD_ORDER = ("term_pos", "parent_id", "direction", "page", "pos")

# Keys of the papers that have been looked up.
DONE = _struct(("ss_id", T.StringType(), False))

def _nullable(**kinds):
    return _struct(*[(name, kind(), True) for name, kind in kinds.items()])


_PLACE = {"term_pos": T.LongType, "parent_id": T.LongType, "direction": T.IntegerType, "page": T.IntegerType, "pos": T.IntegerType}
_FOUND = {"title": T.StringType, "abstract": T.StringType, "search_term": T.StringType, "num_hops": T.IntegerType, "url": T.StringType}
DISCOVERIES = _nullable(ss_id=T.StringType, **_PLACE, **_FOUND)
REJECTS = _nullable(
    search_term=T.StringType, parent_ss_id=T.StringType, direction=T.IntegerType, page=T.IntegerType, pos=T.IntegerType, problem=T.StringType
)
# Edges without a paper at an end, and at which.
ORPHANS = _nullable(ss_id=T.StringType, reference_id=T.StringType, no_source=T.BooleanType, no_target=T.BooleanType)
PAGE_REJECTS = _nullable(search_term=T.StringType, page=T.LongType, item=T.IntegerType, problem=T.StringType)

# A curated corpus has the columns of the corpus it was picked from.
PAPERS_CURATED = PAPERS

# Edges point from the citing paper to the cited one.
EDGES = _struct(
    ("ss_id", T.StringType(), False),
    ("reference_id", T.StringType(), False),
)

TERMS = _struct(
    ("term_pos", T.LongType(), False),
    ("term", T.StringType(), True),
)

# One landed look-up per row; a paper with many neighbours has several pages.
RESPONSES = _struct(
    ("id", T.LongType(), False),
    ("ss_id", T.StringType(), False),
    ("direction", T.IntegerType(), False),
    ("page", T.IntegerType(), True),
    ("status", T.IntegerType(), True),
    ("body", T.StringType(), True),
)

RESULT_PAGES = _struct(
    ("term", T.StringType(), True),
    ("page", T.LongType(), False),
    ("html", T.StringType(), True),
)

# The layout before `papers` took its present columns.
LEGACY_PAPERS = _struct(
    ("id", T.IntegerType(), False),
    ("paper_id", T.StringType(), False),
    ("corpus_id", T.StringType(), True),
    ("title", T.StringType(), False),
    ("author", T.StringType(), True),
    ("publication_date", T.StringType(), True),
    ("abstract", T.StringType(), False),
    ("search_term", T.StringType(), True),
    ("num_hops", T.IntegerType(), True),
    ("url", T.StringType(), True),
)

LEGACY_EDGES = _struct(
    ("paper_id", T.StringType(), False),
    ("reference_id", T.StringType(), False),
)
