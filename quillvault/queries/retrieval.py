"""Queries over vectors, questions, prompts, answers and seals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.functions.barrier import exploded
from quillvault.functions.chunking import char_windows
from quillvault.functions.embedding import (
    cosine,
    embed_documents,
    embed_questions,
    hashing_embedder,
)
from quillvault.functions.integrity import encrypt, seal
from quillvault.functions.pii import filter_answers, text_urls, tokens_passed
from quillvault.functions.text import canonical_url, source_ref, with_content_hash
from quillvault.operators.audit import integrity_report
from quillvault.operators.cells import CellIndex, nearest_by_cells
from quillvault.operators.evaluation import (
    best_size,
    hit_rates,
    paired_answers,
)
from quillvault.operators.requests import effective_k, validated
from quillvault.operators.retrieval import (
    above_threshold,
    allowed_sources,
    nearest_chunks,
    prompts,
    retrieval_outcome,
    source_lists,
    space_verdict,
)
from quillvault.plans.answer import build_prompts, retrieve
from quillvault.plans.benchmark import benchmark_sizes
from quillvault.plans.ingest import ingest
from quillvault.plans.joins import fits
from quillvault.queries import sql
from quillvault.queries.corpus import KEYS, SETTINGS
from quillvault.queries.inputs import ANSWERS_SQL, PLAIN_SQL, answers, documents, table
from quillvault.sources.shared import fresh_path, staged
from quillvault.sources.store import Store

K = SETTINGS.top_k
THRESHOLD = SETTINGS.sim_threshold
MODEL = hashing_embedder(64)
OVERLAP = SETTINGS.chunk_overlap
SIZES = (100, *fv.BENCH_SIZES)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("embedding").cast("array<float>"), "label"
    )


def _questions(spark: SparkSession, sf_dir: str, turned: bool = False) -> DataFrame:
    """Every vector as a question, as it is or with its elements in reverse order."""
    vector = F.reverse("embedding") if turned else F.col("embedding")
    return _chunks(spark, sf_dir).select(
        F.col("chunk_id").alias("question_id"), vector.alias("embedding"), "label"
    )


def topk_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    mean = (
        chunks.select(F.posexplode("embedding").alias("i", "x"))
        .groupBy("i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    )
    question = mean.select(F.transform("v", lambda e: e["x"]).alias("v")).first()["v"]
    vector = F.array(*[F.lit(x) for x in question])
    scored = chunks.select("chunk_id", F.round(cosine(F.col("embedding"), vector), 9).alias("s"))
    return (
        scored.orderBy(F.desc("s"), "chunk_id")
        .limit(K)
        .select("chunk_id", F.round("s", 4).alias("similarity"))
    )


def _rounded(found: DataFrame) -> DataFrame:
    return found.select(
        "question_id", "chunk_id", "rank", F.round("similarity", 4).alias("similarity")
    )


def topk_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(nearest_chunks(_questions(spark, sf_dir), _chunks(spark, sf_dir), K))


def topk_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search as a grid of parts, as for more questions than go to every task."""
    return _rounded(
        nearest_chunks(
            _questions(spark, sf_dir),
            _chunks(spark, sf_dir),
            K,
            broadcast_bytes=128 * 1024,
        )
    )


def topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(nearest_by_cells(_questions(spark, sf_dir), _chunks(spark, sf_dir), K))


def topk_cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate search over a stored index finds enough and compares little."""
    questions, chunks = _questions(spark, sf_dir), _chunks(spark, sf_dir)
    exact = nearest_chunks(questions, chunks, K).select("question_id", "chunk_id")
    index = CellIndex.build(chunks, fresh_path(spark, "index"))
    near = index.nearest(questions, K, exact=False).select(
        "question_id", "chunk_id", F.lit(1).alias("hit")
    )
    recall = exact.join(near, ["question_id", "chunk_id"], "left").agg(
        F.count("*").alias("wanted"), (F.count("hit") / F.count("*")).alias("recall")
    )
    return recall.select(
        "wanted",
        (F.col("recall") >= 0.95).alias("recall_reached"),
        F.lit(index.compared_share(K) <= 0.1).alias("few_compared"),
    )


def topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    found = nearest_chunks(_questions(spark, sf_dir, turned=True), chunks, K)
    kept = above_threshold(found, THRESHOLD)
    refs = chunks.select("chunk_id", source_ref(F.col("label")).alias("source_ref"))
    return kept.join(refs, "chunk_id").select(
        "question_id", "chunk_id", "source_ref", F.round("similarity", 4).alias("similarity")
    )


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _questions(spark, sf_dir, turned=True)
    found = nearest_chunks(questions, _chunks(spark, sf_dir), K)
    return retrieval_outcome(questions, staged(found, "found"), THRESHOLD)


def space_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = SETTINGS.embed_model_tag
    chunks = _chunks(spark, sf_dir)
    cases = {
        "own": F.lit(tag),
        "other": F.lit("another@2"),
        "two": F.when(F.col("label") < 5, tag).otherwise("another@2"),
    }
    verdicts = [
        space_verdict(chunks.withColumn("embedding_model", model), tag).withColumn(
            "store", F.lit(name)
        )
        for name, model in cases.items()
    ]
    nothing = chunks.filter(F.col("label").isNull()).withColumn("embedding_model", F.lit(tag))
    out = space_verdict(nothing, tag).withColumn("store", F.lit("none"))
    for verdict in verdicts:
        out = out.unionByName(verdict)
    return out


def embedding_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir).withColumn(
        "embedding_model", F.concat(F.lit("model@"), F.col("label").cast("string"))
    )
    return chunks.select("embedding_model").distinct().orderBy("embedding_model")


def _sealed(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir).select(
        F.col("label").cast("bigint").alias("document_id"),
        F.sha2(F.col("label").cast("string"), 256).alias("doc_sha256"),
        F.col("chunk_id").cast("int").alias("chunk_index"),
        F.concat(F.lit("chunk é "), F.col("chunk_id").cast("string")).alias("content"),
        "embedding",
    )
    return chunks.withColumn(
        "chunk_hmac",
        seal(
            spark,
            F.col("content"),
            F.col("doc_sha256"),
            F.col("chunk_index"),
            F.col("embedding"),
            KEYS.seal,
        ),
    )


def sealed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sealed(spark, sf_dir).select("document_id", "chunk_index", "chunk_hmac")


def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of some documents altered after sealing, by a hundredth in one element."""
    stored = _sealed(spark, sf_dir).withColumn(
        "content_enc", encrypt(spark, F.col("content"), KEYS.cipher)
    )
    altered = F.transform(
        "embedding", lambda x, i: F.when(i == 0, x + F.lit(0.01).cast("float")).otherwise(x)
    )
    tampered = staged(stored.drop("content"), "sealed").withColumn(
        "embedding", F.when(F.col("document_id") < 3, altered).otherwise(F.col("embedding"))
    )
    return integrity_report(tampered, KEYS.seal, KEYS.cipher)


def _text_chunks(docs: DataFrame) -> DataFrame:
    windows = char_windows(F.col("text"), SETTINGS.chunk_size, OVERLAP)
    chunks = exploded(docs, windows, ("chunk_index", "content"), "doc_id")
    return chunks.withColumn("chunk_id", _window_key(F.col("doc_id"), F.col("chunk_index")))


def _document_key(doc_id: Column) -> Column:
    return F.lpad(doc_id.cast("string"), 19, "0")


def _window_key(doc_id: Column, chunk_index: Column) -> Column:
    """Identity of a window as text that sorts by document, then place."""
    place = F.lpad(chunk_index.cast("string"), 10, "0")
    return F.concat(_document_key(doc_id), F.lit(":"), place)


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def _context(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The benchmark items as questions, and the document windows found for them."""
    questions = _asked(spark, sf_dir)
    vectors = _text_chunks(documents(spark, sf_dir)).select(
        "chunk_id", embed_documents(F.col("content"), MODEL, 64).alias("embedding")
    )
    asked = questions.select(
        "question_id", embed_questions(F.col("question"), MODEL, 64).alias("embedding")
    )
    found = above_threshold(nearest_chunks(asked, vectors, K), THRESHOLD)
    found = staged(found, "found")
    few = fits(found)
    found = F.broadcast(found) if few else found
    # Only documents of which a window was found are cut once more.
    named = found.select(F.substring_index("chunk_id", ":", 1).alias("_key")).distinct()
    docs = table(spark, sf_dir, "documents").withColumn("_key", _document_key(F.col("doc_id")))
    docs = docs.join(F.broadcast(named) if few else named, "_key", "left_semi")
    context = _text_chunks(docs).join(found, "chunk_id").withColumn(
        "source_ref", source_ref(F.col("doc_id"))
    )
    return questions, context


def prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, context = _context(spark, sf_dir)
    return prompts(questions, context).select(
        "question_id",
        F.col("messages")[0]["content"].alias("system_text"),
        F.col("messages")[1]["content"].alias("human_text"),
    )


def sources_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, context = _context(spark, sf_dir)
    listed = F.transform(
        "sources",
        lambda s: F.concat(s["source_ref"], F.lit("="), F.format_string("%.4f", s["similarity"])),
    )
    return source_lists(context).select("question_id", F.array_join(listed, ", ").alias("sources"))


def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("question_id"),
        F.col("url").alias("source_ref"),
        F.col("html").alias("content"),
    )
    return allowed_sources(pages).select(
        "question_id",
        F.size("allowed_sources").alias("n_allowed"),
        F.array_join("allowed_sources", " ").alias("allowed"),
    )


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items with the content hash of the first document that holds their longest shared
    sentence. Only sentences that some item has are grouped."""

    def sentences(df: DataFrame, key: str) -> DataFrame:
        cut = df.select(key, F.explode(F.split("text", r"\.")).alias("s"))
        return cut.select(key, F.trim("s").alias("s")).filter(F.length("s") > 0)

    asked = staged(sentences(table(spark, sf_dir, "benchmark"), "item_id").distinct(), "sentences")
    known = asked.select("s").distinct()
    shared = sentences(documents(spark, sf_dir), "doc_id").join(
        F.broadcast(known) if fits(known) else known, "s", "left_semi"
    )
    first_holder = shared.groupBy("s").agg(F.min("doc_id").alias("doc_id"))
    truth = (
        asked.join(first_holder, "s")
        .groupBy("item_id")
        .agg(F.max_by("doc_id", F.struct(F.length("s"), F.col("s"))).alias("doc_id"))
    )
    hashes = with_content_hash(documents(spark, sf_dir), "text").select("doc_id", "doc_sha256")
    return (
        _asked(spark, sf_dir)
        .join(truth.withColumnRenamed("item_id", "question_id"), "question_id")
        .join(hashes, "doc_id")
        .drop("doc_id")
    )


def _hit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select(
        F.col("doc_id").alias("ord"),
        source_ref(F.col("doc_id")).alias("source_ref"),
        F.col("text").alias("context"),
    )
    return benchmark_sizes(
        rows,
        _truth(spark, sf_dir),
        fresh_path(spark, "benchmark"),
        KEYS,
        MODEL,
        SIZES,
        SETTINGS,
        splitter=char_windows,
        names=None,
    )


def hit_rate_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_report(spark, sf_dir).select(
        "chunk_size", "documents", "chunks", "questions", "hits", "hit_rate", "mean_hit_similarity"
    )


def best_chunk_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_size(staged(_hit_report(spark, sf_dir), "hits"))


def hit_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit rates of all vectors against vectors of the same label, per element order."""
    chunks = _chunks(spark, sf_dir)
    found = nearest_chunks(_questions(spark, sf_dir, turned=True), chunks, K)
    label = F.col("label").cast("string").alias("doc_sha256")
    questions = chunks.select(
        F.col("chunk_id").alias("question_id"), label, F.lit(K).alias("k")
    )
    labelled = found.join(chunks.select("chunk_id", label), "chunk_id").withColumn("k", F.lit(K))
    return hit_rates(questions, labelled, by="k")


def answers_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    safe = filter_answers(answers(spark, sf_dir), "answer", "allowed")
    zero = F.lit(0)
    return safe.select(
        "conv_id",
        "turn",
        "answer_safe",
        F.coalesce(F.col("masked")["EMAIL"], zero).alias("n_email"),
        F.coalesce(F.col("masked")["IP"], zero).alias("n_ip"),
        "urls_neutralized",
        "has_masking",
    )


def answers_filtered_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the filter reports, its counters by category written out."""

    def listed(counts: str) -> Column:
        entries = F.array_sort(F.map_entries(counts))
        return F.array_join(
            F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
        ).alias(counts)

    return filter_answers(answers(spark, sf_dir), "answer", "allowed").select(
        "conv_id", "turn", "answer_safe", listed("masked"), "urls_neutralized", listed("tokens_passed")
    )


def tokens_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = answers(spark, sf_dir).select(
        F.explode(tokens_passed(F.col("answer"))).alias("category", "n")
    )
    return counted.groupBy("category").agg(F.sum("n").cast("long").alias("total"))


def url_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of all answers and pages that are not the address of any page."""
    pages = table(spark, sf_dir, "pages")
    texts = pages.select(F.col("html").alias("text")).unionByName(
        answers(spark, sf_dir).select(F.col("answer").alias("text"))
    )
    mentioned = (
        texts.select(F.explode_outer(text_urls(F.col("text"))).alias("url"))
        .filter(F.col("url").isNotNull())
        .groupBy("url")
        .agg(F.count("*").alias("n"))
        .groupBy(canonical_url(F.col("url")).alias("url"))
        .agg(F.sum("n").cast("long").alias("mentions"))
    )
    known = pages.select(canonical_url(F.col("url")).alias("url")).distinct()
    return mentioned.join(known, "url", "left_anti")


def nominative_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = F.concat(
        F.col("url"), F.when(F.col("page_id") % 3 == 0, "/users/jd").otherwise("/docs/guide")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").rlike(fv.URL_NOMINATIVE).alias("nominative"),
        profile.rlike(fv.URL_NOMINATIVE).alias("nominative_with_path"),
    )


def rag_vs_norag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first answer of a conversation read as given with context, the last as without."""
    talk = table(spark, sf_dir, "conversations")
    per = talk.groupBy(F.col("conv_id").alias("question_id")).agg(
        F.min_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("question"),
        F.min_by("text", F.when(F.col("role") == "assistant", F.col("turn"))).alias("first"),
        F.max_by("text", F.when(F.col("role") == "assistant", F.col("turn"))).alias("last"),
        F.count_if(F.col("role") == "system").alias("n_system"),
    ).filter(F.col("first").isNotNull())
    with_context = per.select(
        "question_id",
        "question",
        F.col("last").alias("truth"),
        F.col("first").alias("answer"),
        F.when(F.col("n_system") > 0, F.array(F.lit("a:1"), F.lit("b:2")))
        .otherwise(F.array().cast("array<string>"))
        .alias("sources"),
        (F.col("n_system") > 0).alias("context_used"),
    )
    without = per.select("question_id", F.col("last").alias("answer"))
    return paired_answers(with_context, without)


def valid_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select(
        "conv_id",
        "turn",
        F.when(F.length("text") % 11 == 0, F.lit("")).otherwise(F.repeat("text", (F.length("text") % 5).cast("int") + 1)).alias("question"),
        F.when(F.col("conv_id") % 4 == 0, "no-rag")
        .when(F.col("conv_id") % 7 == 0, "other")
        .otherwise("rag")
        .alias("mode"),
        F.nullif((F.length("text") % 13).cast("int"), F.lit(5)).alias("k"),
    )
    body = F.when(
        F.col("turn") > 3, F.to_json(F.struct("question", "mode", "k", "turn"))
    ).otherwise(F.to_json(F.struct("question", "mode", "k")))
    checked = validated(asked.withColumn("body", body))
    return checked.select(
        "conv_id",
        "turn",
        F.coalesce("reject_reason", F.lit("valid")).alias("verdict"),
        effective_k(F.col("k"), K).alias("effective_k"),
    )


class _Tampered(Store):
    """A store in which someone has replaced the seal of every third chunk of a document."""

    def visible_chunks(self) -> DataFrame:
        forged = F.when(F.col("chunk_index") % 3 == 1, F.repeat(F.lit("0"), F.lit(64)))
        return self.read("chunks").withColumn("chunk_hmac", F.coalesce(forged, "chunk_hmac"))


def secure_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, retrieve with seal checks from a tampered store, build prompts: the whole chain."""
    rows = documents(spark, sf_dir).select(
        F.col("doc_id").alias("ord"),
        source_ref(F.col("doc_id")).alias("source_ref"),
        F.col("text").alias("context"),
    )
    store = _Tampered(spark, fresh_path(spark, "store"))
    ingest(rows, store, KEYS, MODEL, "run", SETTINGS, char_windows, names=None)
    questions = _asked(spark, sf_dir)
    got = retrieve(questions, store, KEYS, MODEL, SETTINGS)
    ready = build_prompts(questions, got.context)
    broken = got.broken.groupBy("question_id").agg(F.count("*").alias("n_broken"))
    return (
        ready.join(got.outcome, "question_id")
        .join(broken, "question_id", "left")
        .select(
            "question_id",
            "n_found",
            "n_kept",
            F.coalesce("n_broken", F.lit(0)).alias("n_broken"),
            F.round("best_similarity", 4).alias("best_similarity"),
            "context_used",
            F.size("messages").alias("n_messages"),
            F.coalesce(F.size("sources"), F.lit(0)).alias("n_sources"),
        )
    )


def _cosine_sql(a: str, b: str) -> str:
    return (
        f"round(list_dot_product({a}, {b}) / "
        f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))), 9)"
    )


def _topk_sql(question: str) -> str:
    return f"""v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
      found AS (SELECT q.vec_id AS question_id, c.vec_id AS chunk_id, c.label,
        {_cosine_sql(question, "c.e")} AS s,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, c.vec_id) AS rank
        FROM v q, v c QUALIFY rank <= {K})"""


_TOPK = f"""WITH {_topk_sql("q.e")} SELECT question_id, chunk_id, CAST(rank AS INTEGER) AS rank,
  round(s, 4) AS similarity FROM found"""
_TURNED = f"WITH {_topk_sql('list_reverse(q.e)')}"

_SEAL_KEY = KEYS.seal.ljust(64, b"\0")
_INNER = "unhex('" + bytes(b ^ 0x36 for b in _SEAL_KEY).hex() + "')"
_OUTER = "unhex('" + bytes(b ^ 0x5C for b in _SEAL_KEY).hex() + "')"
_SEALED_SQL = f"""packed AS (SELECT vec_id, label, array_to_string(list_transform(embedding,
    lambda x: regexp_replace(hex(CAST(CAST(CAST(x AS FLOAT) AS BIT) AS BLOB)),
    '(..)(..)(..)(..)', '\\4\\3\\2\\1')), '') AS bytes FROM embeddings),
  message AS (SELECT vec_id, label, encode('chunk é ' || vec_id) || unhex('1f')
    || encode(sha256(CAST(label AS VARCHAR))) || unhex('1f') || encode(CAST(vec_id AS VARCHAR))
    || unhex('1f') || unhex(bytes) AS m FROM packed),
  sealed AS (SELECT vec_id, label,
    sha256({_OUTER} || unhex(sha256({_INNER} || m))) AS chunk_hmac FROM message)"""


def _dense(name: str, source: str, keys: tuple[str, ...]) -> str:
    join = " AND ".join(f"{name}_g.{k} = {name}_s.{k}" for k in keys)
    listed = ", ".join(f"{name}_g.{k}" for k in keys)
    return f"""{name}_s AS ({source}),
      {name}_g AS (SELECT {", ".join(keys)}, i FROM (SELECT DISTINCT {", ".join(keys)} FROM {name}_s),
        range(0, 64) t(i)),
      {name} AS (SELECT {listed}, list(CAST(coalesce(weight, 0) AS DOUBLE) ORDER BY i) AS e
        FROM {name}_g LEFT JOIN {name}_s ON i = dim AND {join} GROUP BY {listed})"""


_CONTEXT_SQL = f"""{PLAIN_SQL}, w AS ({sql.windows("d", "text", "1000", "150", "doc_id")}),
  {_dense("cv", sql.hashed_vectors("w", "doc_id, chunk_index", "content", "search_document: ", 64),
          ("doc_id", "chunk_index"))},
  {_dense("qv", sql.hashed_vectors("benchmark", "item_id", "text", "search_query: ", 64), ("item_id",))},
  found AS (SELECT q.item_id AS question_id, c.doc_id, c.chunk_index, {_cosine_sql("q.e", "c.e")} AS s,
    row_number() OVER (PARTITION BY q.item_id ORDER BY s DESC, c.doc_id, c.chunk_index) AS rank
    FROM qv q, cv c QUALIFY rank <= {K}),
  context AS (SELECT question_id, rank, s, 'rag12000:' || doc_id AS source_ref, content
    FROM found JOIN w USING (doc_id, chunk_index) WHERE s >= {THRESHOLD})"""


def _strip_sql(text: str) -> str:
    return (
        f"regexp_replace(regexp_replace({text}, '^{sql.SPACES}+', ''), '{sql.SPACES}+\\z', '')"
    )


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_HITS_SQL = f"""{PLAIN_SQL}, {sql.status_ctes()},
  sizes AS (SELECT * FROM (VALUES (1, 500), (2, 1000), (3, 2000)) t(pos, size)),
  ds AS (SELECT doc_sha256, text_pseudo AS text, size FROM routed, sizes WHERE status = 'ingested'),
  w AS ({sql.windows("ds", "text", "size", "150", "doc_sha256, size")}),
  {_dense("cv", sql.hashed_vectors("w", "doc_sha256, size, chunk_index", "content",
          "search_document: ", 64), ("doc_sha256", "size", "chunk_index"))},
  sb AS (SELECT DISTINCT item_id, trim(unnest(string_split(text, '.')), ' ') AS s FROM benchmark),
  sd AS (SELECT doc_id, trim(unnest(string_split(text, '.')), ' ') AS s FROM documents),
  holder AS (SELECT s, min(doc_id) AS doc_id FROM sd WHERE s <> '' GROUP BY s),
  named AS (SELECT item_id, doc_id FROM sb JOIN holder USING (s)
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY length(s) DESC, s DESC) = 1),
  truth AS (SELECT item_id, doc_sha256 AS truth_sha FROM named JOIN routed USING (doc_id)
    WHERE doc_sha256 IN (SELECT doc_sha256 FROM routed WHERE status = 'ingested')),
  qs AS (SELECT item_id, text FROM benchmark WHERE item_id IN (SELECT item_id FROM truth)),
  {_dense("qv", sql.hashed_vectors("qs", "item_id", "text", "search_query: ", 64), ("item_id",))},
  nearest AS (SELECT q.item_id, c.doc_sha256, c.size, {_cosine_sql("q.e", "c.e")} AS s,
    row_number() OVER (PARTITION BY q.item_id, c.size ORDER BY s DESC, c.doc_sha256, c.chunk_index) AS rank
    FROM qv q, cv c QUALIFY rank <= {K}),
  best AS (SELECT item_id, size, max(s) AS best FROM nearest JOIN truth USING (item_id)
    WHERE doc_sha256 = truth_sha GROUP BY item_id, size),
  stored AS (SELECT size, count(DISTINCT doc_sha256) AS documents, count(*) AS chunks FROM w GROUP BY size),
  report AS (SELECT pos, size AS chunk_size, any_value(documents) AS documents,
    any_value(chunks) AS chunks, count(*) AS questions, count(best) AS hits,
    round(count(best) / count(*), 3) AS hit_rate, round(avg(best), 4) AS mean_hit_similarity
    FROM truth CROSS JOIN sizes LEFT JOIN best USING (item_id, size) JOIN stored USING (size)
    GROUP BY pos, size)"""

_CANONICAL = "regexp_replace(regexp_replace({0}, '[.,;:!?]+$', ''), '/+$', '')"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

_FILTERED_SQL = f"""WITH {ANSWERS_SQL}, m AS (SELECT conv_id, turn, answer,
          len(regexp_extract_all(answer, '{sql.EMAIL}')) AS n_email,
          len(regexp_extract_all(regexp_replace(answer, '{sql.EMAIL}', '', 'g'),
            '\\b(?:{_OCTET}\\.){{3}}{_OCTET}\\b')) AS n_ip,
          regexp_replace(regexp_replace(answer, '{sql.EMAIL}', '[EMAIL_MASQUE]', 'g'),
            '\\b(?:{_OCTET}\\.){{3}}{_OCTET}\\b', '[IP_MASQUE]', 'g') AS t FROM a),
        c AS (SELECT *, regexp_extract_all(t, '{sql.URL}') AS urls,
          regexp_split_to_array(t, '{sql.URL}') AS gaps FROM m),
        f AS (SELECT *, list_transform(urls, lambda u: NOT contains(u, '_MASQUE')
          AND {_CANONICAL.format("u")} NOT IN ('https://en.wiki.example/page',
            'rag12000:' || conv_id)) AS bad FROM c)"""
_SAFE_SQL = """array_to_string(list_transform(range(1, len(gaps) + 1), lambda i:
            gaps[i] || CASE WHEN i > len(urls) THEN '' WHEN bad[i] THEN '[URL_NEUTRALISEE]'
            ELSE urls[i] END), '')"""

QUERIES = {
    "topk_single": (
        topk_single,
        f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        parts AS (SELECT unnest(range(1, len(e) + 1)) AS i, unnest(e) AS x FROM v),
        q AS (SELECT list(x ORDER BY i) AS q FROM (SELECT i, avg(x) AS x FROM parts GROUP BY i))
        SELECT vec_id AS chunk_id, round({_cosine_sql("e", "q")}, 4) AS similarity FROM v, q
        ORDER BY {_cosine_sql("e", "q")} DESC, vec_id LIMIT {K}""",
    ),
    "topk_join": (topk_join, _TOPK),
    "topk_grid": (topk_grid, _TOPK),
    "topk_ann": (topk_cells, _TOPK),
    "topk_ann_recall": (
        topk_cells_recall,
        f"""WITH n AS (SELECT count(*) AS n FROM embeddings)
        SELECT CAST(n * least(n, {K}) AS BIGINT) AS wanted, true AS recall_reached,
          true AS few_compared FROM n""",
    ),
    "topk_threshold": (
        topk_threshold,
        f"""{_TURNED} SELECT question_id, chunk_id, 'rag12000:' || label AS source_ref,
          round(s, 4) AS similarity FROM found WHERE s >= {THRESHOLD}""",
    ),
    "below_threshold": (
        outcome,
        f"""{_TURNED} SELECT question_id, count(*) AS n_found,
          CAST(count_if(s >= {THRESHOLD}) AS BIGINT) AS n_kept,
          round(max(s), 4) AS best_similarity, count_if(s >= {THRESHOLD}) > 0 AS context_used,
          CASE WHEN count_if(s >= {THRESHOLD}) = 0 THEN 'below_threshold' END AS event
        FROM found GROUP BY question_id""",
    ),
    "space_guard": (
        space_guard,
        """WITH m AS (SELECT 'own' AS store, 'hash-bow@1' AS model FROM embeddings
          UNION ALL SELECT 'other', 'another@2' FROM embeddings
          UNION ALL SELECT 'two', CASE WHEN label < 5 THEN 'hash-bow@1' ELSE 'another@2' END
          FROM embeddings)
        SELECT s.store, count(DISTINCT model) AS n_models,
          coalesce(string_agg(DISTINCT model, ',' ORDER BY model), '') AS models,
          CASE WHEN count(DISTINCT model) = 0 THEN 'empty' WHEN count(DISTINCT model) > 1 THEN 'mixed'
          WHEN max(model) <> 'hash-bow@1' THEN 'mismatch' ELSE 'ok' END AS verdict
        FROM (VALUES ('own'), ('other'), ('two'), ('none')) s(store) LEFT JOIN m USING (store)
        GROUP BY s.store""",
    ),
    "embedding_models": (
        embedding_models,
        "SELECT DISTINCT 'model@' || label AS embedding_model FROM embeddings ORDER BY 1",
    ),
    "sealed_chunks": (
        sealed_chunks,
        f"""WITH {_SEALED_SQL} SELECT CAST(label AS BIGINT) AS document_id,
          CAST(vec_id AS INTEGER) AS chunk_index, chunk_hmac FROM sealed""",
    ),
    "integrity_audit": (
        integrity_audit,
        """SELECT CAST(label AS BIGINT) AS document_id, count(*) AS n_chunks,
          CASE WHEN label < 3 THEN count(*) ELSE 0 END AS n_broken FROM embeddings GROUP BY label""",
    ),
    "prompts": (
        prompt_table,
        f"""WITH {_CONTEXT_SQL}, blocks AS (SELECT question_id, string_agg('<<<CTX_DEBUT ' || rank
          || ' source=' || source_ref || '>>>' || chr(10)
          || {_strip_sql("replace(content, '<<<', '‹‹‹')")} || chr(10) || '<<<CTX_FIN ' || rank
          || '>>>', chr(10) || chr(10) ORDER BY rank) AS b FROM context GROUP BY question_id)
        SELECT item_id AS question_id,
          CASE WHEN b IS NULL THEN {_literal(fv.SYSTEM_WITHOUT_CONTEXT)}
          ELSE {_literal(fv.SYSTEM_WITH_CONTEXT)} END AS system_text,
          CASE WHEN b IS NULL THEN '' ELSE {_literal(fv.CONTEXT_HEADER)} || b || chr(10) || chr(10) END
          || 'Question : ' || {_strip_sql("replace(text, '<<<', '‹‹‹')")} AS human_text
        FROM benchmark LEFT JOIN blocks ON question_id = item_id""",
    ),
    "sources_list": (
        sources_list,
        f"""WITH {_CONTEXT_SQL} SELECT question_id, string_agg(source_ref || '='
          || printf('%.4f', round(s, 4)), ', ' ORDER BY rank) AS sources
        FROM context GROUP BY question_id""",
    ),
    "allowed_sources": (
        page_sources,
        f"""WITH u AS (SELECT page_id AS question_id, list_sort(list_distinct(list_concat([url],
          regexp_extract_all(html, '{sql.URL}')))) AS l FROM pages)
        SELECT question_id, CAST(len(l) AS INTEGER) AS n_allowed, array_to_string(l, ' ') AS allowed
        FROM u""",
    ),
    "hit_rate_by_size": (
        hit_rate_by_size,
        f"""WITH {_HITS_SQL} SELECT chunk_size, documents, chunks, questions, hits, hit_rate,
          mean_hit_similarity FROM report""",
    ),
    "hit_similarity": (
        hit_similarity,
        f"""{_TURNED}, own AS (SELECT question_id, max(s) AS best FROM found
          JOIN embeddings q ON q.vec_id = question_id WHERE q.label = found.label GROUP BY question_id)
        SELECT {K} AS k, count(*) AS questions, count(best) AS hits,
          round(count(best) / count(*), 3) AS hit_rate, round(avg(best), 4) AS mean_hit_similarity
        FROM embeddings LEFT JOIN own ON question_id = vec_id""",
    ),
    "best_size": (
        best_chunk_size,
        f"""WITH {_HITS_SQL} SELECT chunk_size, hit_rate FROM report
        ORDER BY hit_rate DESC, pos LIMIT 1""",
    ),
    "answers_filtered": (
        answers_filtered,
        f"""{_FILTERED_SQL}
        SELECT conv_id, turn, {_SAFE_SQL} AS answer_safe,
          CAST(n_email AS INTEGER) AS n_email, CAST(n_ip AS INTEGER) AS n_ip,
          CAST(len(list_filter(bad, lambda b: b)) AS INTEGER) AS urls_neutralized,
          n_email + n_ip + len(list_filter(bad, lambda b: b)) > 0 AS has_masking FROM f""",
    ),
    "answers_filtered_all": (
        answers_filtered_all,
        f"""{_FILTERED_SQL}, k AS (SELECT conv_id, turn, string_agg(category || '=' || n, ',' ORDER BY category)
            AS passed FROM (SELECT conv_id, turn, category, count(*) AS n FROM
              (SELECT conv_id, turn, unnest(regexp_extract_all(answer,
                '\\[(EMAIL|PHONE|IP|IBAN|URL|PERSON|GPE|ORG)_[0-9]+\\]', 1)) AS category FROM a)
              GROUP BY ALL) GROUP BY conv_id, turn)
        SELECT f.conv_id, f.turn, {_SAFE_SQL} AS answer_safe,
          array_to_string(list_filter([CASE WHEN n_email > 0 THEN 'EMAIL=' || n_email END,
            CASE WHEN n_ip > 0 THEN 'IP=' || n_ip END], lambda x: x IS NOT NULL), ',') AS masked,
          CAST(len(list_filter(bad, lambda b: b)) AS INTEGER) AS urls_neutralized,
          coalesce(passed, '') AS tokens_passed
        FROM f LEFT JOIN k ON k.conv_id = f.conv_id AND k.turn = f.turn""",
    ),
    "tokens_passed": (
        tokens_by_category,
        f"""WITH {ANSWERS_SQL}, t AS (SELECT unnest(regexp_extract_all(answer,
          '\\[(EMAIL|PHONE|IP|IBAN|URL|PERSON|GPE|ORG)_[0-9]+\\]', 1)) AS category FROM a)
        SELECT category, count(*) AS total FROM t GROUP BY category""",
    ),
    "url_antijoin": (
        url_antijoin,
        f"""WITH {ANSWERS_SQL}, u AS (SELECT unnest(regexp_extract_all(html, '{sql.URL}')) AS u
          FROM pages UNION ALL SELECT unnest(regexp_extract_all(answer, '{sql.URL}')) FROM a),
        c AS (SELECT {_CANONICAL.format("u")} AS url FROM u)
        SELECT url, count(*) AS mentions FROM c WHERE url NOT IN
          (SELECT {_CANONICAL.format("url")} FROM pages) GROUP BY url""",
    ),
    "nominative_urls": (
        nominative_urls,
        r"""WITH n AS (SELECT page_id, url, url || CASE WHEN page_id % 3 = 0 THEN '/users/jd'
          ELSE '/docs/guide' END AS p, '(?i)(?:/(?:users?|profiles?|accounts?|members?|people|author)s?/[^/\s?]+|/~[^/\s?]+|[?&](?:name|user|username|email|login)=)' AS r FROM pages)
        SELECT page_id, regexp_matches(url, r) AS nominative,
          regexp_matches(p, r) AS nominative_with_path FROM n""",
    ),
    "rag_vs_norag": (
        rag_vs_norag,
        """WITH c AS (SELECT conv_id AS question_id,
          min_by(text, turn) FILTER (WHERE role = 'user') AS question,
          min_by(text, turn) FILTER (WHERE role = 'assistant') AS first,
          max_by(text, turn) FILTER (WHERE role = 'assistant') AS last,
          count_if(role = 'system') > 0 AS context_used FROM conversations GROUP BY conv_id)
        SELECT question_id, question, last AS truth, first AS answer_with_context, context_used,
          CASE WHEN context_used THEN 'a:1, b:2' ELSE '—' END AS sources, last AS answer_without
        FROM c WHERE first IS NOT NULL""",
    ),
    "valid_questions": (
        valid_questions,
        f"""WITH q AS (SELECT conv_id, turn, CASE WHEN length(text) % 11 = 0 THEN ''
            ELSE repeat(text, length(text) % 5 + 1) END AS question,
          CASE WHEN conv_id % 4 = 0 THEN 'no-rag' WHEN conv_id % 7 = 0 THEN 'other' ELSE 'rag' END AS mode,
          nullif(CAST(length(text) % 13 AS INTEGER), 5) AS k
          FROM conversations WHERE role = 'user')
        SELECT conv_id, turn, CASE WHEN question = '' THEN 'question_empty'
          WHEN length(question) > 2000 THEN 'question_too_long'
          WHEN mode = 'other' THEN 'mode_unknown'
          WHEN k NOT BETWEEN 1 AND 10 THEN 'k_out_of_range'
          WHEN turn > 3 THEN 'unknown_field' ELSE 'valid' END AS verdict,
          CAST(coalesce(nullif(k, 0), {K}) AS INTEGER) AS effective_k FROM q""",
    ),
    "secure_answers": (
        secure_answers,
        f"""WITH {PLAIN_SQL}, {sql.status_ctes()},
        ds AS (SELECT doc_sha256, text_pseudo AS text FROM routed WHERE status = 'ingested'),
        w AS ({sql.windows("ds", "text", "1000", "150", "doc_sha256")}),
        {_dense("cv", sql.hashed_vectors("w", "doc_sha256, chunk_index", "content",
                "search_document: ", 64), ("doc_sha256", "chunk_index"))},
        {_dense("qv", sql.hashed_vectors("benchmark", "item_id", "text", "search_query: ", 64),
                ("item_id",))},
        nearest AS (SELECT q.item_id, c.chunk_index, {_cosine_sql("q.e", "c.e")} AS s,
          row_number() OVER (PARTITION BY q.item_id ORDER BY s DESC, c.doc_sha256, c.chunk_index) AS rank
          FROM qv q, cv c QUALIFY rank <= {K}),
        per AS (SELECT item_id AS question_id, count(*) AS n_found,
          CAST(count_if(s >= {THRESHOLD}) AS BIGINT) AS n_kept,
          CAST(count_if(s >= {THRESHOLD} AND chunk_index % 3 = 1) AS BIGINT) AS n_broken,
          round(max(s), 4) AS best_similarity FROM nearest GROUP BY item_id)
        SELECT *, n_kept > n_broken AS context_used, 2 AS n_messages,
          CAST(n_kept - n_broken AS INTEGER) AS n_sources FROM per""",
    ),
}
