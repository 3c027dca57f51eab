"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import alignment, bpe, huffman, mixing, phrases, pii, quality_neighbours, quality_rules, repeats, simhash, topk, toxicity, warc
from tallyloom.llm.common import held_out, labelled_sample, scratch, stored, table

# Labelled texts each model may learn from at most; what is applied to the documents has no bound.
MOST_LABELLED = 12_000
MOST_NEIGHBOURS = 6_000


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    sample = labelled_sample(table(spark, folder, "labels"), documents, "toxic", MOST_LABELLED)
    scored = toxicity.score(documents, toxicity.fit(sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         toxicity.predicted(F.col("score")).alias("predicted"))


def op2_quality_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    sample = labelled_sample(table(spark, folder, "labels"), documents, "quality", MOST_NEIGHBOURS)
    scored = quality_neighbours.score(documents, quality_neighbours.fit(sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         quality_neighbours.predicted(F.col("score")).alias("predicted"))


# The mixture: whole-number weights by level; names that are not listed weigh 1.
MIX_WEIGHTS = {"domain": {"web": 2, "books": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MIX_EPOCHS, MIX_SEED = 2, 20240101


def mix_domain() -> Column:
    """Sources whose name ends in 0 to 4 count as web, all others as books."""
    return F.when(F.substring("source", -1, 1).isin("0", "1", "2", "3", "4"), F.lit("web")).otherwise(F.lit("books"))


def mix_budget() -> Column:
    """Three quarters of the tokens there are."""
    return F.expr("(tokens * 3) div 4")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return mixing.drawn_counts(documents, mix_domain(), MIX_WEIGHTS, mix_budget(), MIX_EPOCHS, MIX_SEED)


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), words_each=3, distance=3)


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages, archive = table(spark, folder, "pages"), scratch(spark, "warc")
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    warc.write(pages, archive, shards, least_bytes=1000)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return warc.read(spark, archive, with_payload=False).select(*columns)


PII_KEY = "key of the test tables"  # a real run takes its key from a secret store


def op3_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pii.surrogates(documents, PII_KEY, counts="n_entities")


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", repeats.digest(F.col("kept")).alias("kept_sha256"))


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op7_decision_lists(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    sample = labelled_sample(table(spark, folder, "labels"), documents, "quality", MOST_LABELLED)
    return quality_rules.judge(documents, quality_rules.fit(sample))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    documents = table(spark, folder, "documents").select("doc_id", "text")
    tokens = bpe.encode(spark, documents, path, pattern, decoded="decoded")
    return tokens.select(
        "doc_id",
        bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_huffman_ids(spark: SparkSession, folder: str) -> DataFrame:
    documents, target = table(spark, folder, "documents"), scratch(spark, "huffman")
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    huffman.write(documents, target, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, shards=shards)
    ids = huffman.read(spark, target)
    return ids.select("doc_id", "start", bpe.token_count(F.col("ids")).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), least=100, longest=5, top=2000)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align(table(spark, folder, "documents"), a_path, b_path)
    kept = stored(aligned.withColumn("groups_sha256", alignment.digest(F.col("groups"))).drop("groups"), "aligned")
    counted = alignment.with_counts(kept, *alignment.vocabulary_sizes(spark, a_path, b_path))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {query.__name__: query for query in (op1_toxicity, op2_quality_neighbours, op3_pii_surrogates, op4_suffix_array_dedup, op5_exact_top_k, op6_warc, op7_decision_lists, op8_byte_bpe, op9_mixing, op10_simhash_near_dedup, op11_huffman_ids, op12_collocations, op13_alignment)}


def _pour_sql(name: str, parent: list[str], own: list[str], weight: str) -> str:
    """One level of the tree: divide what ``name``'s parents have among the nodes of the level."""
    by = f"partition by {', '.join(parent)}" if parent else ""
    join = f"join {name}_above using ({', '.join(parent)})" if parent else f"cross join {name}_above"
    return f"""
        {name}_nodes as (
            select {', '.join(own)}, sum(tokens) tokens, sum(tokens) * {MIX_EPOCHS} cap, {weight} weight from leaves group by {', '.join(own)}
        ), {name}_sorted as (
            select n.*, budget, case when cap > 0 then cast(cap as double) / weight else 0 end ratio, case when cap > 0 then weight else 0 end w
            from {name}_nodes n {join}
        ), {name}_run as (
            select *, budget - coalesce(sum(cap) over ({by} order by ratio, {own[-1]} rows between unbounded preceding and 1 preceding), 0) left_over,
                sum(w) over ({by} order by ratio, {own[-1]} rows between current row and unbounded following) rest
            from {name}_sorted
        ), {name}_full as (select *, cap * rest <= w * left_over full_up from {name}_run
        ), {name}_open as (
            select *, budget - coalesce(sum(case when full_up then cap end) over ({by}), 0) over_all,
                sum(case when not full_up then w end) over ({by}) open_w
            from {name}_full
        ), {name} as (
            select {', '.join(own)}, tokens, case when full_up then cap else (over_all * w) // open_w end budget from {name}_open
        )"""


def _weight_sql(level: str) -> str:
    given = MIX_WEIGHTS.get(level, {})
    cases = " ".join(f"when '{value}' then {weight}" for value, weight in given.items())
    return f"case {level} {cases} else 1 end" if given else "1"


SQL: dict[str, str] = {
    "op9_mixing": f"""
        with placed as (
            select doc_id, case when right(source, 1) in ('0', '1', '2', '3', '4') then 'web' else 'books' end as "domain",
                coalesce(lang, 'unknown') lang, coalesce(source, 'unknown') source,
                cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as hugeint) tokens
            from documents
        ), leaves as (select "domain", lang, source, sum(tokens) tokens from placed group by all
        ), a_above as (select least(sum(tokens) * 3 // 4, sum(tokens) * {MIX_EPOCHS}) budget from leaves),
        {_pour_sql("a", [], ['"domain"'], _weight_sql("domain"))},
        b_above as (select "domain", budget from a),
        {_pour_sql("b", ['"domain"'], ['"domain"', "lang"], _weight_sql("lang"))},
        c_above as (select "domain", lang, budget from b),
        {_pour_sql("c", ['"domain"', "lang"], ['"domain"', "lang", "source"], "1")},
        planned as (
            select "domain", lang, source, budget, case when tokens > 0 then budget // tokens else 0 end epochs,
                case when tokens > 0 then budget % tokens else 0 end rest
            from c
        ), keyed as (
            select p.*, budget, epochs, rest,
                md5('{MIX_SEED}:' || cast(epochs as varchar) || ':' || coalesce(cast(doc_id as varchar), 'null')) as draw
            from placed p join planned using ("domain", lang, source)
        ), summed as (
            select *, sum(tokens) over (partition by "domain", lang, source order by draw range between unbounded preceding and current row) upto
            from keyed
        )
        select doc_id, "domain", lang, source, cast(tokens as bigint) tokens, cast(budget as bigint) leaf_budget,
            cast(epochs + case when rest > 0 and upto <= rest then 1 else 0 end as integer) copies
        from summed
    """,
    "op6_warc": """
        with pages_once as (
            select page_id, encode(coalesce(html, '')) payload from pages
        ), sized as (
            select page_id, cast(octet_length(payload) as bigint) payload_bytes, sha1(payload) payload_digest from pages_once
        ), kept as (
            select *, case when payload_bytes >= 1000
                then max(page_id) over (partition by payload_digest, payload_bytes) else page_id end keeper from sized
        )
        select page_id, payload_bytes, payload_digest,
            case when keeper = page_id or keeper is null then 'response' else 'revisit' end record_type,
            case when keeper <> page_id or page_id is null then keeper end refers_to
        from kept
    """,
    "op5_exact_top_k": """
        with usable as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) v
            from embeddings
            where len(embedding) > 0 and vec_id is not null
              and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
        ), scored as (
            select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) score
            from usable q join usable c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
        )
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank, vec_id, score
        from scored qualify rank <= 20
    """,
    "op12_collocations": """
        with pieces as (
            select row_number() over () piece, coalesce(lang, 'und') lang,
                unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) words
            from documents
        ), split as (
            select lang, list_filter(string_split_regex(words, '[\x20\x09]+'), lambda w: w <> '') w from pieces
        ), grams as (
            select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) phrase
            from split, range(1, 6) sizes(k) where len(w) >= k
        ), counted as (select lang, k, phrase, count(*) a from grams group by all having count(*) >= 100
        ), totals as (select lang, cast(sum(len(w)) as hugeint) n from split group by lang
        ), long as (select *, string_split(phrase, ' ') w from counted where k > 1
        ), cuts as (
            select lang, phrase, k, a, cut, array_to_string(w[1:cut], ' ') head, array_to_string(w[cut + 1:], ' ') tail
            from long, range(1, 5) places(cut) where cut < k
        ), scores as (
            select c.lang, c.phrase, c.a, cut, x.a l, y.a r, n, (1000 * cast(c.a as hugeint) * n) // (cast(x.a as hugeint) * y.a) score
            from cuts c join counted x on x.lang = c.lang and x.phrase = head join counted y on y.lang = c.lang and y.phrase = tail join totals t on t.lang = c.lang
        ), least as (
            select * from scores qualify row_number() over (partition by lang, phrase order by score, cut) = 1
        ), inside as (
            select lang, a longer, unnest(list_transform(range(1, k - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) phrase
            from long, range(2, 5) sizes(size) where size < k
        ), largest as (select lang, phrase, max(longer) longer from inside group by all
        )
        select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as integer) rank, phrase, a, l, r, cast(n as bigint) n, cast(score as bigint) score
        from least left join largest using (lang, phrase) where longer is null or 100 * longer < 100 * a qualify rank <= 2000
    """,
}
