"""The dealt operators over their whole tables, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontamination, knn, lexical, licenses, line_dedup, mixing, periodic, pii, sharding, simhash, spans, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP1_WORDS = "regexp_extract_all(" + _FOLDED.format("text") + ", '[0-9a-z\\x{80}-\\x{10FFFF}]+')"


@check(f"""
WITH item AS (
  SELECT item_id, {_OP1_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), item_window AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_OP1_WORDS}, []) AS w FROM documents
), occurrence AS (
  SELECT r, p, d.n, item_id
  FROM (
    SELECT r, n, i AS p, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item_window))
  ) d JOIN item_window USING (win)
), hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM occurrence) GROUP BY r
), item_list AS (
  SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM occurrence) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN item_list USING (r)
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix arrays over the training text: benchmark windows of 10 words in every document."""
    found = decontamination.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items_sha256", "contaminated"
    )


@check()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labels that are not held out."""
    return toxicity.scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@check()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 3-word shingles, linked at 3 or fewer bits."""
    found = simhash.classes(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@check(r"""
WITH line AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS value, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k
  FROM documents
), pair AS (
  SELECT doc_id, k, value || chr(10) || lead(value) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM line
), later AS (
  SELECT doc_id, k FROM pair WHERE run IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, k) > 1
), later_long AS (
  SELECT doc_id, k FROM line WHERE len(regexp_extract_all(value, '[^\x20\x09-\x0D]+')) > 50
  QUALIFY row_number() OVER (PARTITION BY value ORDER BY doc_id, k) > 1
), gone AS (
  SELECT doc_id, k + d AS k FROM later, (VALUES (0), (1)) AS t(d) UNION SELECT doc_id, k FROM later_long
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(g.k) AS n_removed, coalesce(string_agg(value, chr(10) ORDER BY k) FILTER (g.k IS NULL), '') AS rest
  FROM line LEFT JOIN gone AS g USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN n_removed > 0 THEN rest ELSE text END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN kept USING (doc_id)
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of two or more lines, and of repeated lines of more than 50 words, deleted."""
    return line_dedup.dedup(load(spark, sf_dir, "documents"))


@check("""
WITH doc AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, '-')) AS spin,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), total AS (
  SELECT source, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS k
  FROM doc GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][(k % 3) + 1]::HUGEINT AS weight, 2 * source_size AS cap, 3 * sum(source_size) OVER () AS budget
  FROM total
), summed AS (
  SELECT *, sum(cap) OVER (ORDER BY cap::DOUBLE / weight, k ROWS UNBOUNDED PRECEDING)::HUGEINT AS gone,
    (sum(weight) OVER () - sum(weight) OVER (ORDER BY cap::DOUBLE / weight, k ROWS UNBOUNDED PRECEDING))::HUGEINT AS rest
  FROM weighed
), filled AS (
  SELECT *, (gone * weight + cap * rest) * 2 <= budget * weight AS is_full FROM summed
), target AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
    ((budget - 2 * coalesce(sum(cap) FILTER (is_full) OVER (), 0)) * weight)::DOUBLE
      / (2 * coalesce(sum(weight) FILTER (NOT is_full) OVER (), 0))::DOUBLE END AS target
  FROM filled
), placed AS (
  SELECT doc.*, target.source_size::BIGINT AS source_size, target,
    (sum(size) OVER (PARTITION BY doc.source ORDER BY spin ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM doc JOIN target ON doc.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target)::BIGINT - start))
    + greatest(0, least(size, floor(target)::BIGINT - start - source_size)))::BIGINT AS taken
FROM placed
""")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted fair queueing of all sources at weights 3, 1, 2 to 150% of all words."""
    plan = mixing.schedule(load(spark, sf_dir, "documents"))
    return plan.orderBy("finish", "id").select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@check()
def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of repeated spans removed but for the first."""
    return spans.dedup(load(spark, sf_dir, "documents"))


@check()
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in whole texts."""
    return licenses.scan(load(spark, sf_dir, "documents"))


@check()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in random order in 16 shards whose counts are at most one apart."""
    placed = sharding.digest(load(spark, sf_dir, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@check("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.vec, v.vec)::BIGINT AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
) WHERE rank <= 10
""")
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all other vectors for every hundredth vector."""
    return knn.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# The rules of the query, in the order they are given.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def _spread(level: str) -> str:
    """The concentration of a level in SQL; see urls._concentration."""
    even = "(rate * (1 - rate))"
    return f"""(SELECT 1 / least(greatest(CASE WHEN room > 0 THEN (s - {even} * (k - 1)) / room ELSE 0.5 END, 0.0001), 0.5) - 1
      FROM (SELECT rate, sum((y - n * rate) * (y - n * rate) / n) AS s, count(*) AS k,
          {even} * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) AS room
        FROM {level}, overall WHERE n > 0 GROUP BY rate))"""


@check(f"""
WITH parsed AS (
  SELECT page_id, strpos(url, '://') AS mark, substr(url, strpos(url, '://') + 3) AS rest FROM pages
), page AS (
  SELECT row_number() OVER () AS r, page_id,
    CASE WHEN mark > 0 THEN {_FOLDED.format("regexp_extract(rest, '^[^/?#]*')")} ELSE '' END AS host,
    CASE WHEN mark > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM parsed
), bad AS (
  SELECT doc_id AS page_id, max((toxic = 1 OR quality = 0)::INTEGER) AS bad FROM labels GROUP BY 1
), host AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS y,
    array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM page LEFT JOIN bad USING (page_id) GROUP BY host
), overall AS (SELECT (sum(y) + 1) / (sum(n) + 10) AS rate FROM host),
by_suffix AS (SELECT suffix, sum(n) AS n, sum(y) AS y FROM host GROUP BY 1),
by_domain AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM host GROUP BY 1, 2),
strength AS (SELECT {_spread("by_suffix")} AS a, {_spread("by_domain")} AS b, {_spread("host")} AS c),
of_suffix AS (SELECT suffix, (y + rate * a) / (n + a) AS suffix_rate FROM by_suffix, overall, strength),
of_domain AS (SELECT domain, suffix, (y + suffix_rate * b) / (n + b) AS domain_rate FROM by_domain JOIN of_suffix USING (suffix), strength),
of_host AS (SELECT host, n, c, (y + domain_rate * c) / (n + c) AS m FROM host JOIN of_domain USING (domain, suffix), strength),
rules(rule_host, rule_path, action) AS (VALUES {", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)}),
fit AS (
  SELECT r, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC) AS k
  FROM page JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(action,
  CASE WHEN m - 1.645 * sqrt(m * (1 - m) / (n + c + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM page JOIN of_host USING (host) LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (r)
""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first, then host reputation. A page's outcome is the label with its id: bad if toxic or of low quality."""
    outcomes = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    )
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge(load(spark, sf_dir, "pages"), outcomes, rules)


_TERMS = "regexp_extract_all(" + _FOLDED.format("text") + ", '[0-9a-z\\x{80}-\\x{10FFFF}]+')"


@check(f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, w, len(w)::BIGINT AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0
), every AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM doc),
item AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT q, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark))
  GROUP BY ALL
), posting AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM doc) GROUP BY ALL
), weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), every
), scored AS (
  SELECT q, item_id, r, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
  FROM item JOIN posting USING (term) JOIN weighed USING (term), every GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0
) WHERE rank <= 20
""")
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best of all documents for every benchmark item, by segments with bounds of term pairs."""
    return lexical.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@check()
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: what the patterns find, and what the field adds."""
    found = pii.find(load(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _planted(docs: DataFrame) -> DataFrame:
    """Ids and texts; where crc32 of the id is a multiple of 10, the words from some place on repeat a period."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(hashed / 10)

    def repeated(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # The words are made once per text: they are what the function is applied to, not a part of it.
    text = F.when(hashed % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@check()
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, and what is left when each is cut to its first period."""
    found = periodic.periodic_runs(_planted(load(spark, sf_dir, "documents")))

    def order(a, b):
        """The greater length/period first, then the smaller start, then the smaller period; products are exact."""
        here, there = a["length"] * b["period"], b["length"] * a["period"]
        return (
            F.when(here != there, F.signum(there - here)).when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
            .otherwise(F.signum(a["period"] - b["period"])).cast("int")
        )

    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    best = F.get(F.array_sort("runs", order), F.lit(0))
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
