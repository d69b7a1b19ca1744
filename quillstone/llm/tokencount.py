"""Operator 8, token counts with the whole-token shortcut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillstone.llm.common import map_slices
from quillstone.llm.pretokens import prove_whole_tokens, word_counter

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """One row a row of docs(doc_id, text): UTF-8 bytes, tokens by the vocabulary file, and whether they exceed limit.

    Which strings are one token is proved on the driver, once a vocabulary, and broadcast: at most as many strings as
    the vocabulary has. Pre-tokens among them count 1; each distinct other one is merged once a task.
    Null and empty texts have no tokens; repeated rows are counted one by one; other columns are ignored.
    """
    proven = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(vocabulary))

    def make():
        counter = word_counter(vocabulary, proven.value)

        def step(rows: dict[str, list]) -> dict[str, list]:
            counts = [counter.count(x) for x in rows["text"]]
            return {
                "doc_id": rows["doc_id"],
                "n_bytes": [len((x or "").encode("utf-8", "surrogatepass")) for x in rows["text"]],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

        return step

    return map_slices(docs.select("doc_id", "text"), SCHEMA, make)
