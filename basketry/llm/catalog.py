"""The named queries of the corpus operators, and their SQL where SQL can express them."""

from pyspark.sql import functions as F

from basketry.llm import (
    centroids, class_ngrams, cover_tree, decontamination, language_crf, merkle, packing, perspectives, prefix_free, simhash, super_kmers, token_scan, warc)
from basketry.llm.common import table
from basketry.llm.manifest_sql import OP12_SQL, OP13_SQL


def op1_wu_manber(spark, sf_dir):
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), null_items=True)
    hit = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op2_warc_archive(spark, sf_dir):
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_records(spark, archive).withColumnRenamed("id", "page_id")


def op3_separator_scan(spark, sf_dir):
    return token_scan.document_token_counts(table(spark, sf_dir, "documents"))


def op4_language_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_crf.fit_on(docs)
    marked = language_crf.label_languages(docs.select("doc_id", "text"), model)
    return marked.select("doc_id", F.coalesce(language_crf.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_perspectives(spark, sf_dir):
    return perspectives.rotate_perspectives(table(spark, sf_dir, "conversations")).select(
        "conv_id", "perspective", F.col("part").cast("long").alias("part"), F.col("n_turns").cast("long").alias("n_turns"),
        F.col("start").cast("long").alias("start"), "text",
        F.array_join(F.transform("masks", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ",").alias("masks"))


def op6_prefix_free_parsing(spark, sf_dir):
    return prefix_free.find_repeats(table(spark, sf_dir, "documents"))


def op7_exact_complement(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_cover_tree(spark, sf_dir):
    found = cover_tree.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"),
                        (F.col("vec_id") == F.col("component")).alias("kept"))


def op9_super_kmers(spark, sf_dir):
    return super_kmers.find_repeated_words(table(spark, sf_dir, "documents"))


def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_brown_classes(spark, sf_dir):
    fifth = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return class_ngrams.score_texts(table(spark, sf_dir, "documents"), held_out=fifth)


def op12_merkle_manifest(spark, sf_dir):
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=third)


def op13_pivot_clusters(spark, sf_dir):
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP1_SQL = r"""
with plain as (
  select kind, id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from (select 'doc' kind, doc_id id, text from documents union all select 'item', item_id, text from benchmark)),
windows as (
  select distinct id item_id, w[i:i + least(10, len(w)) - 1] win
  from (select id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from plain where kind = 'item' and len(w) > 0)),
sizes as (select distinct len(win) k from windows),
places as (
  select id doc_id, k, unnest(range(1, len(w) - k + 2)) i, w from plain, sizes where kind = 'doc' and len(w) >= k),
hits as (select doc_id, i, k, item_id from places join windows on places.w[i:i + k - 1] = win),
words as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from hits) group by doc_id),
items as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids
  from (select distinct doc_id, cast(item_id as varchar) item_id from hits) group by doc_id)
select id doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from plain left join words on id = words.doc_id left join items on id = items.doc_id where kind = 'doc'
"""

_DIGEST = " || ".join(
    f"translate(lpad(to_base(cast('0x' || substring(h, {at}, 10) as bigint), 32), 8, '0'), '{warc.CONV_DIGITS}', '{warc.BASE32_DIGITS}')"
    for at in (1, 11, 21, 31))
OP2_SQL = f"""
with p as (select page_id, coalesce(html, '') html, sha1(coalesce(html, '')) h, max(page_id) over (partition by coalesce(html, '')) m from pages)
select page_id, cast(strlen(html) as bigint) payload_bytes, {_DIGEST} payload_digest,
  case when page_id = m then 'response' else 'revisit' end record_type, case when page_id <> m then m end refers_to
from p
"""

OP5_SQL = """
with t as (
  select conv_id, coalesce(role, 'unknown') role, coalesce(text, '') text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, 'unknown'), coalesce(text, '')) - 1 pos
  from conversations),
people as (select distinct conv_id, role perspective from t),
lines as (
  select t.conv_id, perspective, pos, pos // 256 part, role = perspective own, text || chr(10) body,
    case when role = perspective then '<|assistant|>' || chr(10) else '<|user|>' || role || chr(10) end head
  from t join people on t.conv_id is not distinct from people.conv_id),
placed as (
  select *, coalesce(sum(length(head) + length(body)) over (partition by conv_id, perspective order by pos
    rows between unbounded preceding and 1 preceding), 0) place
  from lines)
select conv_id, perspective, cast(part as bigint) part, count(*) n_turns, cast(min(place) as bigint) "start",
  string_agg(head || body, '' order by pos) as text,
  coalesce(string_agg(cast(cast(place as bigint) + length(head) as varchar) || '-' || cast(cast(place as bigint) + length(head) + length(body) as varchar), ','
    order by pos) filter (where own), '') masks
from placed group by conv_id, perspective, part
"""


def oracle_sql():
    return {"op1_wu_manber": OP1_SQL, "op2_warc_archive": OP2_SQL, "op5_perspectives": OP5_SQL,
            "op12_merkle_manifest": OP12_SQL, "op13_pivot_clusters": OP13_SQL}
