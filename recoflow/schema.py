"""Schema of the action log and its stream, and the fixed values of scores and experiments."""

from __future__ import annotations

from pyspark.sql import types as T

ACTION_PARAM = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("articleId", T.StringType()),
    T.StructField("algorithmCombine", T.StringType()),
])

# One log line, and the JSON value of the click stream.
USER_ACTION = T.StructType([
    T.StructField("actionTime", T.StringType()),
    T.StructField("readTime", T.StringType()),
    T.StructField("channelId", T.IntegerType()),
    T.StructField("param", ACTION_PARAM),
])

# Weight of each kind of action in the interest score.
SHARE_SCORE = 3
CLICK_SCORE = 5
COLLECT_SCORE = 2
LONG_READ_SCORE = 2
SHORT_READ_SCORE = 1

# Experiment buckets (first md5 digit), their strategy, its
# recall sources and its ranking service.
BUCKETS = {
    "Algo-1": ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "a", "b", "c", "d"],
    "Algo-2": ["e", "f"],
}
STRATEGIES = {
    "Algo-1": {"sources": ["als", "content", "online", "new", "hot"], "sort": "LR"},
    "Algo-2": {"sources": ["als", "content", "online", "new", "hot"], "sort": "WDL"},
}
