"""One query per operator over its whole table, and the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination as dc
from strata.llm import license_scan as ls
from strata.llm import repetition as rp
from strata.llm import url_filter as uf
from strata.llm import warc
from strata.llm.bpe_automaton import encoded
from strata.llm.collocations import collocations
from strata.llm.common import UPPER, table
from strata.llm.jaccard_join import linked_documents
from strata.llm.packing import pack
from strata.llm.ranked_search import build_index, search
from strata.llm.secret_scan import scan_secrets
from strata.llm.token_counts import token_counts
from strata.llm.toxicity import held_out, score_texts, train

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = "block net/, allow example.net/en/, block example.com/de/, allow org/fr/"
TOKEN_LIMIT = 1024
SEQUENCE = 4096
LONGEST_REPEAT = 50
COVERED_SHARE = 60


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


_LOWER = f"'{UPPER}', '{UPPER.lower()}'"


@query(
    """
    WITH p AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
    ), g AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, payload_bytes, p.payload_digest,
           CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
    FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest
    """
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived_pages(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("damaged record: "), "error")).cast("string"))
    return records.select(
        warc.id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.coalesce(checked, "record_type").alias("record_type"),
        warc.id_of(F.col("refers_to")).alias("refers_to"),
    )


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    f"""
    WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, CAST(least(len(w), 10) AS BIGINT) AS n
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)
    ),
    docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    spots AS (
        SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
        FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM windows))
    ),
    found AS (SELECT r, i, s.n, item_id FROM spots s JOIN windows USING (gram)),
    hit AS (
        SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY r
    ),
    named AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
    """
)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = dc.contamination(docs, "doc_id", "text", items, "item_id", "text")
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query(
    f"""
    WITH u AS (
        SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {_LOWER}) AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
        FROM pages
    ), r AS (
        SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                       WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM u
    ), listed AS (
        SELECT host FROM r WHERE host <> '' GROUP BY host
        HAVING count(*) FILTER (rule IN ('net/', 'example.com/de/')) >= 0.25 * count(*)
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict
    FROM r
    """
)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls that no rule fits are judged by their host: listed are hosts of which a quarter of all urls is blocked."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return uf.judge_urls(pages, "url", uf.parse_rules(URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def _license_sql() -> str:
    """The same steps: sentences, identifiers, then the rules one after the other on the text of identifiers."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = {}
    for name, parts in ls.known_parts(ls.SENTENCES):
        known.update(dict.fromkeys(parts, name))
    body = "coalesce(text, '')"
    for pattern, by in ls.WRAPS:
        body = f"regexp_replace({body}, {quoted(pattern)}, {quoted(by)}, 'g')"
    pairs = ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in known.items())
    marked = " OR ".join(f"contains(translate(coalesce(text, ''), {_LOWER}), {quoted(mark)})" for mark in ls.MARKS)
    normal = f"regexp_replace(trim(regexp_replace(translate(s, {_LOWER}), '[^a-z0-9.]+', ' ', 'g')), ' ?\\.$', '')"
    steps, names = [], []
    for number, (name, ids) in enumerate(ls.RULES):
        run = quoted(" " + "  ".join(ids) + " ")
        steps.append(f"r{number + 1} AS (SELECT *, replace(s{number}, {run}, ' \t ') AS s{number + 1}, contains(s{number}, {run}) AS f{number} FROM r{number})")
        names.append(f"CASE WHEN f{number} THEN {quoted(name)} END")
    last = len(ls.RULES)
    return f"""
    WITH names AS (SELECT MAP {{{pairs}}} AS known),
    cut AS (
        SELECT doc_id, string_split_regex(coalesce(text, ''), {quoted(ls.SENTENCE_END)}) AS printed,
               CASE WHEN {marked} THEN string_split_regex({body}, {quoted(ls.SENTENCE_END)}) ELSE [] END AS parts
        FROM documents
    ),
    seen AS (
        SELECT doc_id, CAST(len(list_filter(printed, lambda s: regexp_matches(s, '[A-Za-z0-9]'))) AS BIGINT) AS n_sentences,
               list_filter(list_transform(parts, lambda s: known[{normal}]), lambda x: x IS NOT NULL) AS ids
        FROM cut, names
    ),
    r0 AS (SELECT *, ' ' || coalesce(array_to_string(ids, '  '), '') || ' ' AS s0 FROM seen),
    {", ".join(steps)}
    SELECT doc_id, n_sentences, CAST(len(ids) AS BIGINT) AS n_known, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
           coalesce(array_to_string(list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL))), ','), '') AS licenses,
           CAST(len(list_filter(string_split_regex(s{last}, '\\s+'), lambda x: x <> '')) AS BIGINT) AS n_left
    FROM r{last}
    """


@query(_license_sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ls.scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select(
        "doc_id",
        "n_sentences",
        F.size("sentence_ids").cast("bigint").alias("n_known"),
        F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
        F.concat_ws(",", "licenses").alias("licenses"),
        "n_left",
    )


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_texts(docs, "text", model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def repetition_verdicts(rows: DataFrame) -> DataFrame:
    """The base, and the method's verdict: repeated substrings of three words or more cover at most COVERED_SHARE percent of the characters of all words, and
    none is longer than LONGEST_REPEAT words or, in texts where a tenth of the words is less, than that tenth, ten words being allowed always."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    few = 100 * F.col("covered_chars") <= COVERED_SHARE * F.col("word_chars")
    longest = F.least(F.lit(LONGEST_REPEAT), F.greatest(F.lit(10), F.col("n_words") / 10))
    return rows.withColumns({"base_failed": failed, "kept": ~failed & few & (F.col("longest_repeat") <= longest)})


@query()
def op9_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition_verdicts(rp.repetition(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path("word_bpe_49k.json"))


@query(
    f"""
    WITH cut AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
    ),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut),
    spots AS (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM pieces, (VALUES (1), (2), (3)) t(k)),
    f AS (SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS f FROM spots GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
    c AS (SELECT lang, k, p, f AS a FROM f WHERE k > 1 AND f >= 10),
    scored AS (
        SELECT c.lang, c.p, a, l.f AS l, r.f AS r, j, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c) c
        JOIN f l ON l.lang = c.lang AND l.p = c.p[:j] JOIN f r ON r.lang = c.lang AND r.p = c.p[j + 1:]
    ),
    lowest AS (SELECT lang, p, unnest(min_by({{a: a, l: l, r: r, score: score}}, (score, j))) FROM scored GROUP BY 1, 2),
    held AS (
        SELECT lang, q AS p, max(a) AS longer FROM (SELECT lang, a, unnest([p[1:2], p[2:3]]) AS q FROM c WHERE k = 3) GROUP BY 1, 2
    ),
    ranked AS (
        SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
               row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
        FROM lowest LEFT JOIN held USING (lang, p)
        WHERE len(p) = 3 OR longer IS NULL OR 100 * longer < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), "text", "lang")


@query()
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path("word_bpe_49k.json"), capacity=SEQUENCE)


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
    stats AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
    q AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
    asked AS (SELECT q, unnest(w) AS term FROM q),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, stats GROUP BY term, n_docs
    ),
    norms AS (SELECT r, doc_id, 10 + (90 * len(w) * n_docs) // n_terms AS m FROM d, stats WHERE len(w) > 0),
    scored AS (
        SELECT q, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN norms USING (r) GROUP BY 1, 2
    ),
    ranked AS (
        SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
        FROM scored JOIN norms USING (r) WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN q USING (q) WHERE rank <= 10
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"), "doc_id", "text")
    return search(index, table(spark, sf_dir, "benchmark"), "item_id", "text", "doc_id", k=10)
