"""The registered query of each operator, over its whole table.

A query digests its operator's rows into the columns it is to return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from entityloom.llm import (
    decontaminate,
    exact,
    language,
    licenses,
    packing,
    personal,
    quality,
    resample,
    simhash,
    spelling,
    substrings,
    toxicity,
    vectors,
)
from entityloom.llm.shipping import ship
from entityloom.plans.registry import SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; the executors get the library along with it."""
    ship(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def tokenizer_file() -> str:
    """Where the tokenizer's package is installed, on the driver and all executors alike."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contamination(docs, benchmark)


def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file())


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.personal_digest(table(spark, folder, "documents"))


def repeats_removed(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removal_digest(table(spark, folder, "documents"))


def toxic(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def good(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(table(spark, folder, "documents"))


def license_notices(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


def vector_groups(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.vector_groups(table(spark, folder, "embeddings"))


def spelling_forms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return spelling.spelling_variants(spelling.word_counts(docs, damage=97))


def drawn(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resample.resampled(docs, benchmark).drop("n_words")


def exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents")).drop("n_chars")


QUERIES: dict[str, Query] = {
    "op1_decontamination": contamination,
    "op2_simhash": simhash_groups,
    "op3_packing": packed,
    "op4_personal": personal_data,
    "op5_substrings": repeats_removed,
    "op6_toxicity": toxic,
    "op7_quality": good,
    "op8_language": languages,
    "op9_licenses": license_notices,
    "op10_vectors": vector_groups,
    "op11_spelling": spelling_forms,
    "op12_resampling": drawn,
    "op13_exact": exact_copies,
}

ITEM_WORDS = r"""regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# CRC-32 by its table, which is made by the rule; ``s`` is a text, ``tab`` the table's list.
CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce(
            list_concat([i], range(8)),
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab"""
CRC = """xor(list_reduce(
            list_concat([4294967295], list_transform(range(strlen(s)), lambda i:
                16 * (instr('0123456789ABCDEF', substr(hex(encode(s)), 2 * i + 1, 1)) - 1)
                + instr('0123456789ABCDEF', substr(hex(encode(s)), 2 * i + 2, 1)) - 1)),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""

SQL: dict[str, str] = {
    "op1_decontamination": f"""
        with doc as (select doc_id, {ITEM_WORDS} as w from documents),
        item as (select item_id, {ITEM_WORDS} as w from benchmark),
        win as (
            select item_id, least(13, len(w)) as span,
                   unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
                       lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) as key
            from item where len(w) > 0),
        spans as (select distinct span from win),
        place as (
            select doc_id, span, unnest(range(1, len(w) - span + 2)) as p, w
            from doc, spans where len(w) >= span),
        occurs as (
            select doc_id, span, p, array_to_string(w[p:p + span - 1], ' ') as key from place),
        hit as (
            select o.doc_id, o.p, o.span, win.item_id from occurs o join win using (span, key)),
        words as (
            select doc_id, count(distinct q) as n_hit
            from (select doc_id, unnest(range(p, p + span)) as q from hit) group by doc_id),
        items as (
            select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as names
            from (select distinct doc_id, cast(item_id as varchar) as i from hit) group by doc_id)
        select doc.doc_id, len(doc.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
               coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(doc.w) as contaminated
        from doc left join words using (doc_id) left join items using (doc_id)
    """,
    "op5_substrings": r"""
        with doc as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
            from documents),
        place as (
            select doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) as key
            from (select doc_id, w, unnest(range(1, len(w) - 33)) as p from doc)),
        again as (select key from place group by key having count(*) > 1),
        gone as (
            select distinct doc_id, unnest(range(p, p + 35)) as q
            from place where key in (select key from again)),
        kept as (
            select doc_id, string_agg(x, ' ' order by q) as kept, count(*) as n_kept
            from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as q from doc) u
            where not exists (select 1 from gone g where g.doc_id = u.doc_id and g.q = u.q)
            group by doc_id)
        select doc.doc_id, len(doc.w)::bigint as n_words,
               (len(doc.w) - coalesce(n_kept, 0))::bigint as n_removed,
               sha256(coalesce(kept, '')) as kept_sha256
        from doc left join kept using (doc_id)
    """,
    "op10_vectors": """
        with recursive unit as (
            select vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as u
            from (select vec_id, cast(embedding as double[]) as e from embeddings)
            where len(e) > 0 and list_dot_product(e, e) > 0),
        link as (
            select a.vec_id as a, b.vec_id as b
            from unit a join unit b on a.vec_id <> b.vec_id
            where list_dot_product(a.u, b.u) >= 0.95),
        reach as (
            select vec_id, vec_id as node from embeddings
            union
            select r.vec_id, l.b from reach r join link l on l.a = r.node),
        part as (select vec_id, min(node) as component_id from reach group by vec_id),
        degree as (select a as vec_id, count(*) as n_links from link group by a)
        select p.vec_id, coalesce(n_links, 0)::bigint as n_links, component_id,
               p.vec_id = component_id as kept
        from part p left join degree d on d.vec_id = p.vec_id
    """,
    "op11_spelling": rf"""
        with recursive table_of as ({CRC_TABLE}),
        run as (
            select coalesce(cast(doc_id as varchar), '') as d, count(*) as c,
                   translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r
            from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''),
                         '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as r from documents)
            group by all),
        coded as (
            select r, c, {CRC} as h from (select *, d || ':' || r as s from run), table_of),
        word as (
            select w as word, sum(c)::bigint as n
            from (select c, case when h % 97 = 0 then
                             r[1:(h % length(r))::bigint] || r[(h % length(r))::bigint + 2:]
                         else r end as w from coded)
            where length(w) >= 5 group by w having sum(c) >= 3),
        cut as (
            select word, n, i, word[1:i - 1] || word[i + 1:] as rest
            from (select word, n, unnest(range(1, length(word) + 1)) as i from word)),
        shorter as (
            select distinct cut.word as a, word.word as b
            from cut join word on word.word = cut.rest),
        near as (
            select x.word as a, y.word as b from cut x join cut y using (i, rest)
            where x.word <> y.word
            union select a, b from shorter
            union select b, a from shorter),
        ranked as (
            select a, b, w.n as n_b, count(*) over (partition by a) as n_near,
                   row_number() over (partition by a order by w.n desc, encode(b)) as place
            from near join word w on w.word = b),
        formed as (
            select word.word, word.n, coalesce(n_near, 0)::bigint as n_near,
                   case when n_b >= 2 * word.n then b end as form,
                   case when n_b >= 2 * word.n then n_b end as form_n
            from word left join ranked on a = word.word and place = 1),
        chain as (
            select word, word as spot, 0 as steps from formed
            union all
            select chain.word, formed.form, steps + 1
            from chain join formed on formed.word = chain.spot where formed.form is not null),
        ends as (select word, max_by(spot, steps) as root from chain group by word)
        select formed.word, form, root, n, n_near, form_n from formed join ends using (word)
    """,
    "op12_resampling": rf"""
        with table_of as ({CRC_TABLE}),
        entry as (
            select 'd' as side, doc_id as id, {ITEM_WORDS} as w from documents
            union all select 't', item_id, {ITEM_WORDS} from benchmark),
        feature as (
            select side, id, unnest(list_concat(w, list_transform(range(1, len(w)),
                       lambda i: w[i] || ' ' || w[i + 1]))) as s from entry),
        coded as (
            select s, {CRC} % 10000 as bucket from (select distinct s from feature), table_of),
        counted as (
            select bucket, count(*) filter (side = 'd') as s, count(*) filter (side = 't') as t
            from feature join coded using (s) group by bucket),
        total as (select sum(s) as s_all, sum(t) as t_all from counted),
        gain as (
            select bucket, floor(1000 * ln(((t + 1) * (s_all + 10000))::double
                       / ((s + 1) * (t_all + 10000))::double))::bigint as gain
            from counted, total),
        weighed as (
            select id as doc_id, count(*) as n, floor(sum(gain) / count(*))::bigint as weight
            from feature join coded using (s) join gain using (bucket)
            where side = 'd' group by id),
        h as (
            select doc_id, len({ITEM_WORDS}) as n_words,
                   ('0x' || sha256('7:' || doc_id)[1:8])::bigint as h from documents),
        scored as (
            select h.doc_id, n_words, coalesce(n, 0)::bigint as n_features,
                   coalesce(weight, 0)::bigint as weight,
                   (coalesce(weight, 0)
                    + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint)::bigint as score
            from h left join weighed using (doc_id)),
        able as (
            select doc_id, row_number() over (order by score desc, doc_id) as rank,
                   count(*) over () as n from scored where n_words >= 20)
        select doc_id, n_features, weight, score,
               case when rank <= 25 * n // 100 then rank end as rank
        from scored left join able using (doc_id)
    """,
    "op13_exact": r"""
        with doc as (
            select doc_id, length(coalesce(text, '')) as chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t
            from documents),
        ranked as (
            select doc_id, t, row_number() over same as place, count(*) over (partition by t) as n,
                   first_value(doc_id) over same as keep_id
            from doc window same as (partition by t order by chars desc, doc_id))
        select doc_id, keep_id, n as group_size, place = 1 as kept, sha256(t) as text_sha256
        from ranked
    """,
}
