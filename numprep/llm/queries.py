"""One query for each operator, over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprep.llm.alignment import align_tokens
from numprep.llm.collocations import collocations
from numprep.llm.common import shared_folder, stored
from numprep.llm.dart_minhash import classes
from numprep.llm.html_extract import extract
from numprep.llm.kd_shards import shard
from numprep.llm.line_quality import judge_documents
from numprep.llm.mixing import measured, mix
from numprep.llm.quality_model import score_quality
from numprep.llm.registry import ORACLES, QUERIES, query, table
from numprep.llm.suffix_dedup import remove_repeats
from numprep.llm.token_count import count_tokens
from numprep.llm.token_files import read_index, write_tokens
from numprep.llm.url_filter import judge, rule_table
from numprep.llm.winnow import report

__all__ = ["ORACLES", "QUERIES"]

#: Fixed values: (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query(r"""
with u as (
    select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) as path
    from pages),
r as (
    select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
        ('org', '/fr/', 'allow')) as t(rule_host, rule_path, rule_verdict)),
j as (
    select u.*, rule_host || rule_path as rule, rule_verdict, row_number() over (partition by page_id
        order by length(rule_host || rule_path) desc nulls last) as place
    from u left join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from j where place = 1
""")
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark, URL_RULES)).drop("url")


@query()
def op5_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return shard(documents, ["n_chars", "doc_id", "source", "lang"], shards=16)


@query(r"""
with d as (
    select doc_id, source, coalesce(text, '') as t,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        (('0x' || substr(sha256('mix|' || coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, 13))::bigint
            + 0.5::double) * pow(2.0, -52) as u,
        length(regexp_replace(coalesce(text, ''), '[^\p{L}]+', '', 'g'))::double
            / greatest(length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')), 1) as q
    from documents),
k as (select *, -ln(u) / greatest(0.05, q * q * q * q) as draw from d),
s as (
    select source, sum(size)::bigint as source_size, row_number() over (order by encode(source) nulls last) - 1 as place
    from k group by source),
w as (select *, [3, 1, 2][place % 3 + 1] as weight, 2 * source_size as cap from s),
c as (
    select *, coalesce(sum(cap) over before, 0) as capped, sum(weight) over rest as open, (select sum(size) from k) as words
    from w
    window before as (order by cap / weight, place rows between unbounded preceding and 1 preceding),
        rest as (order by cap / weight, place rows between current row and unbounded following)),
l as (select arg_min((1.5::double * words - capped) / open, cap / weight) as share from c
    where cap / weight >= (1.5::double * words - capped) / open),
g as (select source, source_size, least(cap::double, weight * share) as target from w, l),
e as (
    select k.doc_id, k.size, g.source_size, g.target,
        case when g.source_size > 0 then floor(target / g.source_size) else 0 end::bigint as epochs,
        coalesce(sum(k.size) over (partition by k.source order by draw, doc_id
            rows between unbounded preceding and 1 preceding), 0) as before
    from k join g on k.source is not distinct from g.source)
select doc_id, size, source_size, target, (epochs * size
    + greatest(0, least(size, round(target)::bigint - epochs * source_size - before)))::bigint as taken from e
""")
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    narrow = stored(measured(documents, "mix").drop("text"), "mix")
    return mix(narrow).select("doc_id", "size", "source_size", "target", "taken")


@query(r"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
v as (
    select distinct item_id, least(10, len(words)) as size, array_to_string(words[s + 1:s + least(10, len(words))], ' ') as piece
    from (select *, unnest(range(0, len(words) - least(10, len(words)) + 1)) as s from b where len(words) > 0)),
z as (select distinct size from v),
p as (
    select doc_id, s, size, array_to_string(words[s + 1:s + size], ' ') as piece
    from (select doc_id, words, size, unnest(range(0, len(words) - size + 1)) as s from d, z where len(words) >= size)),
o as (select p.doc_id, p.s, p.size, v.item_id from p join v on p.size = v.size and p.piece = v.piece),
h as (
    select doc_id, count(distinct w) as n_hit from (select doc_id, unnest(range(s, s + size)) as w from o) group by doc_id),
i as (
    select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
    from (select distinct doc_id, item_id::varchar as item from o) group by doc_id)
select d.doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h on d.doc_id = h.doc_id left join i on d.doc_id = i.doc_id
""")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op3_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query()
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_index(spark, path)


@query()
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = judge_documents(table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return verdicts.select("doc_id", *counts, "base_failed", "kept", "words_left")


@query()
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return classes(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size", "kept")


@query()
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op2_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


@query()
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    models = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokens(table(spark, folder, "documents"), *models)


@query(r"""
with d as (
    select coalesce(lang, 'und') as lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces from documents),
p as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from (select lang, unnest(pieces) as piece from d)),
s as (select lang, words, unnest(range(1, len(words) + 1)) as i from p),
o as (
    select lang, size, array_to_string(words[i:i + size - 1], ' ') as phrase from s, range(1, 5) t(size)
    where i + size - 1 <= len(words)),
f as (select lang, phrase, size, count(*) as f from o group by all having count(*) >= 30),
n as (select lang, sum(len(words))::bigint as n from p group by lang),
w as (select lang, phrase, size, f, string_split(phrase, ' ') as words from f where size > 1),
c as (
    select w.lang, w.phrase, w.f as a, k, x.f as l, y.f as r, (2000000::hugeint * w.f // (x.f + y.f))::bigint as score
    from w, range(1, 4) t(k)
    join f x on x.lang = w.lang and x.phrase = array_to_string(w.words[1:k], ' ')
    join f y on y.lang = w.lang and y.phrase = array_to_string(w.words[k + 1:], ' ')
    where k < w.size),
b as (select * from c qualify row_number() over (partition by lang, phrase order by score, k) = 1),
g as (
    select lang, phrase, max(f) as f from (
        select lang, array_to_string(words[i:i + m - 1], ' ') as phrase, f from w, range(1, 4) t(i), range(2, 4) u(m)
        where m < size and i + m - 1 <= size)
    group by all)
select b.lang, row_number() over best as rank, b.phrase, a, l, r, n, score
from b join n using (lang) left join g on g.lang = b.lang and g.phrase = b.phrase
where g.f is null or 100::hugeint * g.f < 80::hugeint * a
window best as (partition by b.lang order by score desc, a desc, encode(b.phrase))
qualify row_number() over best <= 2000
""")
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


@query()
def op12_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
