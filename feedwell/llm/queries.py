"""The registered queries of this subpackage, and DuckDB SQL where it can express one."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwell.llm import licenses, secret_scan
from feedwell.llm.compression import fit_quality
from feedwell.llm.conversations import damage, repair
from feedwell.llm.html_text import extract_text
from feedwell.llm.jaccard import link_documents
from feedwell.llm.lexical import search
from feedwell.llm.neighbours import nearest
from feedwell.llm.packing import pack_sequences
from feedwell.llm.shared import Scratch
from feedwell.llm.sharding import MOST_BITS, assign_shards
from feedwell.llm.tiling import contaminated
from feedwell.llm.token_file import write_tokens
from feedwell.llm.toxicity import fit_toxicity

#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20
#: Folder-independent names of the vocabularies; their paths are parameters of the operators.
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_neighbours(spark: SparkSession, d: str) -> DataFrame:
    vectors = _table(spark, d, "embeddings")
    with Scratch(spark) as scratch:
        return scratch.result(nearest(vectors, vectors.filter("vec_id % 100 = 0"), scratch))


def op2_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Labels of every fifth document, by a checksum of its id, are not learnt from."""
    docs = _table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    with Scratch(spark) as scratch:
        model = fit_toxicity(docs, _table(spark, d, "labels").filter(~held_out), scratch)
    scored = model.score(docs).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("sentences").alias("offending"))


def op3_token_ids(spark: SparkSession, d: str) -> DataFrame:
    """Written as token files, then read back from them."""
    with Scratch(spark) as scratch:
        files = write_tokens(_table(spark, d, "documents"), public_tokenizers.path(WORD_BPE), 2, scratch)
    return files.read()


def op4_main_text(spark: SparkSession, d: str) -> DataFrame:
    return extract_text(_table(spark, d, "pages"))


def op5_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    with Scratch(spark) as scratch:
        return scratch.result(link_documents(_table(spark, d, "documents"), scratch, width=3, percent=90))


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage and the share of its words found."""
    hits = contaminated(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return hits.select("doc_id", "item_id", "n_words", "covered", "coverage")


def op7_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_sequences(_table(spark, d, "documents"), public_tokenizers.path(BYTE_BPE), 0).drop("ids")


def _is_kind(number: int):
    return lambda s: s["kind"] == number


def op8_secrets(spark: SparkSession, d: str) -> DataFrame:
    with Scratch(spark) as scratch:
        found = secret_scan.find_secrets(_table(spark, d, "documents").select("doc_id", "text"), scratch=scratch, texts=False)
    counts = [
        F.size(F.filter("_base", _is_kind(n))).cast("long").alias(f"n_{kind}") for n, kind in enumerate(secret_scan.BASE)
    ]
    base = F.sha2(secret_scan.listed("_base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secret_scan.listed("_secrets").alias("spans"))


def op9_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, d, "documents"), licenses.known_texts(spark))


def op10_shards(spark: SparkSession, d: str) -> DataFrame:
    with Scratch(spark) as scratch:
        return assign_shards(_table(spark, d, "documents"), SHARD_BYTES, scratch=scratch)


def op11_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    with Scratch(spark) as scratch:
        return scratch.result(search(_table(spark, d, "documents"), _table(spark, d, "benchmark"), scratch))


def op12_quality(spark: SparkSession, d: str) -> DataFrame:
    """Labels of every fourth document, by a checksum of its id, are not learnt from."""
    docs = _table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    with Scratch(spark) as scratch:
        model = fit_quality(docs, _table(spark, d, "labels").filter(~held_out), scratch)
    scored = model.score(docs).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "score", "predicted", "n_bytes", "good_bytes", "bad_bytes")


def op13_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Conversations after damage; those without rows then have no faults, an empty audit and an empty text."""
    rows = _table(spark, d, "conversations")
    with Scratch(spark) as scratch:
        found = repair(damage(rows), scratch)
        digests = found.digests().select(F.col("conv_id").alias("digest_of"), "repaired_sha256")
        audits = found.audits.withColumnRenamed("conv_id", "audit_of")
        whole = rows.select("conv_id").distinct().join(audits, F.col("conv_id").eqNullSafe(F.col("audit_of")), "left")
        whole = whole.join(digests, F.col("conv_id").eqNullSafe(F.col("digest_of")), "left")
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        return scratch.result(whole.select(
            "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_toxicity": op2_toxicity,
    "op3_token_ids": op3_token_ids,
    "op4_main_text": op4_main_text,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_secrets": op8_secrets,
    "op9_licenses": op9_licenses,
    "op10_shards": op10_shards,
    "op11_lexical_search": op11_lexical_search,
    "op12_quality": op12_quality,
    "op13_conversations": op13_conversations,
}


# --- the same in SQL ---------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    folded = f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    words = f"regexp_replace({folded}, {_quoted(licenses.COPYRIGHT)}, chr(10), 'g')"
    words = rf"regexp_replace(' ' || {words} || ' ', '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    words = rf"regexp_replace({words}, ' ?\n ?', ' ' || chr(10) || ' ', 'g')"
    for pattern, instead in licenses.SPELLINGS:
        words = f"regexp_replace({words}, {_quoted(pattern)}, {_quoted(instead.replace('$', chr(92)))}, 'g')"
    return words


def _joined_sql(lines: str) -> str:
    return rf"trim(regexp_replace({lines}, '[ \n]+', ' ', 'g'))"


def _values(rows: list[tuple[str, str]]) -> str:
    return ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in rows)


def _licenses_sql() -> str:
    """Every text, title, name and id that the query knows, in every wording."""
    texts, named, tagged = [*licenses.NOTICES.items(), *licenses.TEXTS.items()], [], []
    for row in licenses.shipped():
        name, names = row["license"], row.get("names", [])
        texts += [(name, title + row["text"]) for title in ("", *(t + "\n\n" for t in row.get("titles", []))) if "text" in row]
        named += [(name, form) for own in names for form in (own, ("a " if own.startswith("Creative Commons") else "the ") + own)]
        tagged += [(name, own) for own in (*names, *([row["id"]] if "id" in row else []))]
    lists = {k: ", ".join(map(_quoted, v)) for k, v in vars(licenses).items() if k in ("SUBJECTS", "VERBS", "ENDS", "TAGS")}
    return f"""
        with bodies as (
            select name, body from (values {_values(texts)}) t(name, body)
            union all
            select name, concat_ws(' ', subject, verb, own, ending) from (values {_values(named)}) t(name, own),
                unnest([{lists['SUBJECTS']}]) u(subject), unnest([{lists['VERBS']}]) v(verb), unnest([{lists['ENDS']}]) w(ending)
            union all
            select name, tag || ' ' || own from (values {_values(tagged)}) t(name, own), unnest([{lists['TAGS']}]) u(tag)),
        known as (select distinct name as license, {_joined_sql(_canonical_sql('body'))} as whole from bodies),
        lined as (select doc_id, {_canonical_sql('text')} as body from documents where text is not null),
        units as (
            select doc_id, 0 as line_no, {_joined_sql('body')} as unit from lined
            union all
            select doc_id, unnest(range(1, len(parts) + 1)), trim(unnest(parts))
            from (select doc_id, string_split(body, chr(10)) as parts from lined where contains(body, chr(10))))
        select doc_id, cast(line_no as integer) as line_no, license
        from units join known on unit = whole where unit <> ''"""


def _shards_sql(limit: int) -> str:
    """The first prefix of a key's bits whose rows fit; by sums over all prefixes of up to 24 bits."""
    return f"""
        with keyed as (
            select doc_id, cast(octet_length(encode(coalesce(text, ''))) as bigint) as bytes,
                cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 14) as bigint) as bits
            from documents),
        levels as (
            select *, unnest(range(25)) as depth from keyed),
        sized as (
            select doc_id, bytes, bits, depth, sum(bytes) over bucket as size, count(*) over bucket as n
            from levels window bucket as (partition by depth, bits >> ({MOST_BITS} - depth)))
        select doc_id, bytes, cast(min(depth) as integer) as depth,
            case min(depth) when 0 then 'all'
                else substr(lpad(format('{{:b}}', bits), {MOST_BITS}, '0'), 1, cast(min(depth) as integer)) end as shard
        from sized where size <= {limit} or n = 1 group by doc_id, bytes, bits"""


def _links_sql(width: int, percent: int) -> str:
    """Shingle sets, all pairs that share a shingle, and whatever a document reaches over links."""
    return rf"""
        with recursive worded as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                '[^\x20\x09-\x0D]+') as words
            from documents),
        sets as (
            select doc_id, case when len(words) = 0 then [] when len(words) < {width} then [array_to_string(words, ' ')]
                else list_distinct([array_to_string(words[i:i + {width - 1}], ' ') for i in range(1, len(words) - {width - 2})])
                end as shingles
            from worded),
        items as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets),
        links as (
            select a.doc_id as x, b.doc_id as y from items a join items b using (shingle)
            where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
        reached as (
            select doc_id, doc_id as other from documents
            union
            select r.doc_id, l.y from reached r join links l on r.other = l.x)
        select doc_id, cast(len(shingles) as bigint) as n_shingles, least_id as component_id
        from sets join (select doc_id, min(other) as least_id from reached group by doc_id) using (doc_id)"""


#: Sums per shared term, and the best 20 of each item.
_SEARCH_SQL = rf"""
    with counted as (
        select doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents),
    items as (
        select item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark),
    wanted as (select item_id, term, count(*) as times from items group by all),
    corpus as (select count(*) as n_docs, sum(len(terms)) as n_terms from counted where len(terms) > 0),
    held as (
        select doc_id, n, term, count(*) as tf from (select doc_id, len(terms) as n, unnest(terms) as term from counted)
        where term in (select term from wanted) group by all),
    weights as (
        select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
        from held, corpus group by term, n_docs),
    scored as (
        select item_id, doc_id, cast(sum(times * (w * ((1000000000 * tf)
            // (1000 * tf + 12 * (75 + (25 * n * n_docs) // cast(n_terms as bigint)))))) as bigint) as score
        from held join weights using (term) join wanted using (term), corpus group by item_id, doc_id)
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
    from scored where score > 0 qualify rank <= 20"""

#: Holds for pages whose article is one element of headings and paragraphs, as in the test tables.
_PAGES_SQL = r"""
    with cut as (
        select page_id, url, string_split_regex(
            regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?b>', '', 'g'),
            '</?(?:p|h1)>') as blocks
        from pages),
    bare as (
        select page_id, url, [trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            b, '<[^>]*>', ' ', 'g'), '&amp;?', '&', 'g'), '&quot;?', '"', 'g'), '\s+', ' ', 'g')) for b in blocks] as blocks
        from cut),
    joined as (select page_id, url, array_to_string([b for b in blocks if b <> ''], chr(10) || chr(10)) as text from bare)
    select page_id, url, text, cast(length(text) as bigint) as n_chars from joined"""

ORACLE_SQL = {
    "op4_main_text": _PAGES_SQL,
    "op5_jaccard_join": _links_sql(3, 90),
    "op9_licenses": _licenses_sql(),
    "op10_shards": _shards_sql(SHARD_BYTES),
    "op11_lexical_search": _SEARCH_SQL,
}
