"""Exact nearest chunks for a table of questions, and what follows from them.

Scores come from matrix products over Arrow batches, so no table of question-chunk pairs exists.
Each task keeps the ``k`` best chunks per question it has seen, and a window ranks what the tasks
kept. Similarities are rounded to nine digits before ranking; equal ones rank by chunk id. Questions
that are too many for every task meet the chunks in a grid of parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quillvault import fixed_values as fv
from quillvault.functions.barrier import settled
from quillvault.functions.pii import text_urls
from quillvault.functions.text import neutralise_frames, strip
from quillvault.sources.shared import staged

BROADCAST_BYTES = 64 * 1024 * 1024
TILE = 512  # questions and
BLOCK = 2048  # chunks per matrix product, which bounds its memory
DIGITS = 9
#: Questions or chunks in a part of a grid, at most.
PART_ROWS = 65_536
#: Questions in a part, at least, where more parts would only keep more cores busy.
LEAST_ROWS = 512
#: Partitions that the pairs of parts are dealt to, at most.
MOST_PAIRS = 4096


def found_schema(chunks: DataFrame, space: str) -> str:
    chunk_id = chunks.schema["chunk_id"].dataType.simpleString()
    return f"question_id bigint, chunk_id {chunk_id}, similarity double, {space} int"


def matrix(vectors: pa.Array) -> np.ndarray:
    """Unit rows of a list-of-float column; a zero vector becomes NaN."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms > 0, norms, np.nan)


def usable_vector(column: str) -> Column:
    """Neither null nor with a null element."""
    return F.col(column).isNotNull() & ~F.exists(column, lambda x: x.isNull())


class Best:
    """The ``k`` best places for each of ``n`` questions: high similarity first, then low place.

    ``least`` are similarities that a place must reach (NaN: none).
    """

    def __init__(self, n: int, k: int, least: np.ndarray | None = None) -> None:
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.places = np.full((n, k), np.iinfo(np.int64).max)
        self.limit = np.full(n, -np.inf) if least is None else np.nan_to_num(least, nan=-np.inf)

    def compare(
        self, rows: np.ndarray, questions: np.ndarray, places: np.ndarray, vectors: np.ndarray
    ) -> None:
        """Compare the questions ``rows`` with vectors, whose places ascend.

        Only what reaches the k-th similarity so far is rounded and sorted, at most ``k`` a question.
        """
        scores = questions @ vectors.T
        near = scores >= (self.limit[rows] - 10.0**-DIGITS)[:, None]
        many = np.count_nonzero(near, axis=1) > self.k
        if many.any():
            near[many] = _chosen(scores[many], self.k)
        row, column = np.nonzero(near)
        if len(row):
            self._merge(rows, row, np.round(scores[row, column], DIGITS), places[column])

    def _merge(
        self, rows: np.ndarray, row: np.ndarray, scores: np.ndarray, places: np.ndarray
    ) -> None:
        found = np.unique(row)
        kept = rows[found]
        row = np.concatenate([np.repeat(found, self.k), row])
        scores = np.concatenate([self.scores[kept].ravel(), scores])
        places = np.concatenate([self.places[kept].ravel(), places])
        order = np.lexsort((places, -scores, row))
        first = np.searchsorted(row[order], found)  # every question has k entries at least
        best = order[first[:, None] + np.arange(self.k)]
        self.scores[kept], self.places[kept] = scores[best], places[best]
        self.limit[kept] = np.maximum(self.limit[kept], self.scores[kept, -1])

    def table(self, question_ids: np.ndarray, ids: np.ndarray) -> pa.Table:
        row, column = np.nonzero(np.isfinite(self.scores))
        return pa.table(
            {
                "question_id": question_ids[row],
                "chunk_id": ids[self.places[row, column]],
                "similarity": self.scores[row, column],
            }
        )


def best_of(
    question_ids: np.ndarray, questions: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> pa.Table:
    """The ``k`` best of ``vectors`` for each question: high similarity first, then low id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    tables = []
    for at in range(0, len(question_ids), TILE):
        asked = questions[at : at + TILE]
        best = Best(len(asked), k)
        for b in range(0, len(ids), BLOCK):
            places = np.arange(b, min(b + BLOCK, len(ids)))
            best.compare(np.arange(len(asked)), asked, places, vectors[b : b + BLOCK])
        tables.append(best.table(question_ids[at : at + TILE], ids))
    return pa.concat_tables(tables)


def _chosen(scores: np.ndarray, k: int) -> np.ndarray:
    """Which ``k`` of a row of scores are its best; among equal ones the leftmost."""
    scores = np.round(scores, DIGITS)
    scores[np.isnan(scores)] = -np.inf
    keep = min(k, scores.shape[1])
    limit = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1 : keep]
    above = scores > limit
    tied = scores == limit
    room = keep - above.sum(axis=1, keepdims=True)
    return (above | (tied & (np.cumsum(tied, axis=1) <= room))) & np.isfinite(scores)


def _keep_best(found: list[pa.Table], k: int) -> pa.Table:
    rows = pa.concat_tables(found).to_pandas()
    rows = rows.sort_values(["question_id", "similarity", "chunk_id"], ascending=[True, False, True])
    return pa.Table.from_pandas(rows.groupby("question_id").head(k), preserve_index=False)


def ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    """Number the best ``k`` rows of each question from 1."""
    best = Window.partitionBy("question_id", *by).orderBy(F.desc("similarity"), "chunk_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest_chunks(
    questions: DataFrame,
    chunks: DataFrame,
    k: int,
    within: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``question_id, chunk_id, similarity, rank`` of the ``k`` nearest chunks per question.

    ``questions`` has ``question_id, embedding`` and ``chunks`` has ``chunk_id, embedding``; a
    chunk id may be a number or a string.
    ``within`` names an integer column of chunks; each of its values is searched separately.
    Questions of checked size go to every task and the chunks are not shuffled. More questions
    than that meet the chunks in a grid of parts, nothing of which goes through the driver.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    size = questions.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim")
    ).first()
    # Settled, so that a vector which a model makes on the way is made once, not again for the filter.
    questions = settled(questions.select("question_id", "embedding"), "embedding")
    questions = questions.filter(usable_vector("embedding"))
    space = within or "_all"
    if not within:
        chunks = chunks.withColumn("_all", F.lit(0))
    chunks = chunks.select(F.col(space).cast("int").alias(space), "chunk_id", "embedding")
    chunks = settled(chunks, "embedding").filter(usable_vector("embedding"))
    group_rows = max(1, broadcast_bytes // max(1, 8 * size["dim"]))
    if size["n"] <= group_rows:
        found = _by_broadcast(questions, chunks, k, space)
    else:
        found = _by_grid(questions, chunks, k, space, size["n"])
    best = ranked(found, k, space)
    return best if within else best.drop("_all")


def _by_broadcast(questions: DataFrame, chunks: DataFrame, k: int, space: str) -> DataFrame:
    local = questions.select("question_id", "embedding").toArrow()
    shared = questions.sparkSession.sparkContext.broadcast(
        (np.asarray(local["question_id"]), matrix(local["embedding"]))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        question_ids, vectors = shared.value
        if not len(question_ids):
            return
        kept: dict[int, list[pa.Table]] = {}
        for batch in batches:
            spaces = np.asarray(batch[space])
            ids = np.asarray(batch["chunk_id"])
            rows = matrix(batch["embedding"])
            for value in np.unique(spaces):
                here = spaces == value
                best = best_of(question_ids, vectors, ids[here], rows[here], k)
                kept.setdefault(int(value), []).append(best)
                if len(kept[int(value)]) > 16:
                    kept[int(value)] = [_keep_best(kept[int(value)], k)]
        for value, tables in kept.items():
            best = _keep_best(tables, k)
            marks = pa.array([value] * len(best), pa.int32())
            yield from best.append_column(space, marks).combine_chunks().to_batches()

    return chunks.mapInArrow(search, found_schema(chunks, space))


def _by_grid(questions: DataFrame, chunks: DataFrame, k: int, space: str, n: int) -> DataFrame:
    """Every part of the questions is compared with every part of the chunks, in a task of its own."""
    chunks = staged(chunks, "chunks")  # counted and dealt, but made only once
    parts = parts_of(chunks.count())

    def search(asked: pa.Table, stored: pa.Table) -> pa.Table:
        question_ids, vectors = np.asarray(asked["question_id"]), matrix(asked["embedding"])
        spaces, ids = np.asarray(stored[space]), np.asarray(stored["chunk_id"])
        rows = matrix(stored["embedding"])
        tables = []
        for value in np.unique(spaces):
            here = spaces == value
            best = best_of(question_ids, vectors, ids[here], rows[here], k)
            marks = pa.array([value] * len(best), pa.int32())
            tables.append(best.append_column(space, marks))
        return pa.concat_tables(tables)

    return met_in_parts(
        questions.select("question_id", "embedding").withColumn("_part", every_part(parts)),
        chunks.withColumn("_part", dealt("chunk_id", parts)),
        groups_of(questions, n, parts),
        parts,
        search,
        found_schema(chunks, space),
    )


def parts_of(n: int, most: int = PART_ROWS) -> int:
    return max(1, -(-n // most))


def groups_of(questions: DataFrame, n: int, parts: int) -> int:
    """Parts of ``n`` questions: of bounded size, and enough to keep all cores busy."""
    cores = questions.sparkSession.sparkContext.defaultParallelism
    busy = min(-(-2 * cores // parts), parts_of(n, LEAST_ROWS))
    return max(parts_of(n), busy)


def dealt(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def every_part(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def met_in_parts(
    asked: DataFrame,
    stored: DataFrame,
    groups: int,
    parts: int,
    search: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """What ``search`` finds for every pair of a part of the questions and a part of the chunks.

    ``_part`` names the part of a chunk, and the part of the chunks that a row of ``asked`` is meant
    for. Questions are dealt to ``groups`` parts; each of them gets the chunks once.
    """
    keys = ["_group", "_part"]
    pairs = min(MOST_PAIRS, groups * parts)
    left = asked.withColumn("_group", dealt("question_id", groups)).repartition(pairs, *keys)
    right = stored.withColumn("_group", every_part(groups)).repartition(pairs, *keys)
    target = asked.sparkSession.createDataFrame([], schema).schema
    empty = to_arrow_schema(target).empty_table()

    def found(one: pa.Table, other: pa.Table) -> pa.Table:
        return search(one, other) if len(one) and len(other) else empty

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(found, target)


def above_threshold(found: DataFrame, threshold: float) -> DataFrame:
    """Found chunks whose similarity reaches the threshold; nothing refills the others' places."""
    return found.filter(F.col("similarity") >= threshold)


def retrieval_outcome(
    questions: DataFrame, found: DataFrame, threshold: float, broken: DataFrame | None = None
) -> DataFrame:
    """Per question: chunks found and kept, best similarity, and the event to log, if any.

    ``broken`` lists kept chunks whose seal does not hold (``question_id``). Context is used only
    where a kept chunk is left; a broken seal alone is not a matter of the threshold.
    """
    per_question = found.groupBy("question_id").agg(
        F.count("*").alias("n_found"),
        F.count_if(F.col("similarity") >= threshold).alias("n_kept"),
        F.round(F.max("similarity"), 4).alias("best_similarity"),
    )
    n_found = F.coalesce("n_found", F.lit(0))
    n_kept = F.coalesce("n_kept", F.lit(0))
    rows = questions.select("question_id").join(per_question, "question_id", "left")
    n_broken = F.lit(0)
    if broken is not None:
        lost = broken.groupBy("question_id").agg(F.count("*").alias("n_broken"))
        rows = rows.join(lost, "question_id", "left")
        n_broken = F.coalesce("n_broken", F.lit(0))
    return (
        rows.select(
            "question_id",
            n_found.alias("n_found"),
            n_kept.alias("n_kept"),
            "best_similarity",
            (n_kept > n_broken).alias("context_used"),
            F.when(n_found == 0, "empty_store")
            .when(n_kept == 0, "below_threshold")
            .alias("event"),
        )
    )


def space_verdict(chunks: DataFrame, configured: str, column: str = "embedding_model") -> DataFrame:
    """One row telling whether all stored vectors come from the configured model."""
    models = chunks.groupBy(column).count().select(column)  # one row per model
    return models.agg(
        F.count(column).alias("n_models"),
        F.array_join(F.array_sort(F.collect_list(column)), ",").alias("models"),
    ).select(
        "n_models",
        "models",
        F.when(F.col("n_models") == 0, "empty")
        .when(F.col("n_models") > 1, "mixed")
        .when(F.col("models") != configured, "mismatch")
        .otherwise("ok")
        .alias("verdict"),
    )


def require_one_space(verdict: DataFrame) -> bool:
    """False for an empty store; an error where vectors cannot be compared."""
    row = verdict.first()
    if row["verdict"] in ("mixed", "mismatch"):
        raise ValueError(f"embedding models differ from the configured one: {row['models']}")
    return row["verdict"] == "ok"


def source_lists(found: DataFrame) -> DataFrame:
    """Sources and rounded similarities per question, best first, one entry per chunk."""
    entry = F.struct(
        "rank", "source_ref", F.round("similarity", 4).alias("similarity")
    )
    return (
        found.groupBy("question_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("_ranked"))
        .select(
            "question_id",
            F.transform(
                "_ranked",
                lambda e: F.struct(
                    e["source_ref"].alias("source_ref"), e["similarity"].alias("similarity")
                ),
            ).alias("sources"),
        )
    )


def allowed_sources(found: DataFrame) -> DataFrame:
    """Per question: the source references and all URLs of the chunks given as context."""
    return found.groupBy("question_id").agg(
        F.array_sort(
            F.array_union(
                F.collect_set("source_ref"),
                F.array_distinct(F.flatten(F.collect_list(text_urls(F.col("content"))))),
            )
        ).alias("allowed_sources")
    )


def context_block(rank: Column, source: Column, content: Column) -> Column:
    """A numbered, framed extract whose inside cannot imitate or close the frame."""
    safe_source = neutralise_frames(F.coalesce(source, F.lit(fv.UNKNOWN_SOURCE)))
    number = rank.cast("string")
    return F.concat(
        F.lit("<<<CTX_DEBUT "),
        number,
        F.lit(" source="),
        safe_source,
        F.lit(">>>\n"),
        strip(neutralise_frames(content)),
        F.lit("\n<<<CTX_FIN "),
        number,
        F.lit(">>>"),
    )


def prompts(questions: DataFrame, context: DataFrame) -> DataFrame:
    """``question_id, messages`` for every question, with or without context.

    ``context`` holds at most k rows per question: ``question_id, source_ref, content, similarity,
    chunk_id``. Blocks are numbered from 1 in order of similarity.
    """
    place = Window.partitionBy("question_id").orderBy(F.desc("similarity"), "chunk_id")
    numbered = context.withColumn("_n", F.row_number().over(place))
    blocks = numbered.groupBy("question_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.struct(
                            "_n",
                            context_block(
                                F.col("_n"), F.col("source_ref"), F.col("content")
                            ).alias("block"),
                        )
                    )
                ),
                lambda b: b["block"],
            ),
            "\n\n",
        ).alias("_blocks")
    )
    asked = F.concat(F.lit(fv.QUESTION_LABEL), strip(neutralise_frames(F.col("question"))))
    has_context = F.col("_blocks").isNotNull()
    system = F.when(has_context, fv.SYSTEM_WITH_CONTEXT).otherwise(fv.SYSTEM_WITHOUT_CONTEXT)
    human = F.when(
        has_context,
        F.concat(F.lit(fv.CONTEXT_HEADER), F.col("_blocks"), F.lit("\n\n"), asked),
    ).otherwise(asked)
    return (
        questions.select("question_id", "question")
        .join(blocks, "question_id", "left")
        .select(
            "question_id",
            F.array(
                F.struct(F.lit("system").alias("role"), system.alias("content")),
                F.struct(F.lit("human").alias("role"), human.alias("content")),
            ).alias("messages"),
        )
    )
