"""topiary: topic analytics on Spark.

Cleans full text, builds tokens, bigrams and phrases, a pruned vocabulary and
bag-of-words features, fits LDA grids, scores them with sliding-window c_v
coherence and answers descriptive questions about document-topic shares.
Every operator is a DataFrame -> DataFrame (or Column -> Column) function on
the public Spark SQL / Spark ML APIs.
"""

from topiary.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
