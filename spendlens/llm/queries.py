"""The operators of this subpackage as queries over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, chunks, codes, decontam, exact, jaccard, language, lexical, pii, quality, sketches, tokenfile

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_classes(table(spark, folder, "documents"))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_copies(table(spark, folder, "documents"))


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


#: Functions that the calls derived from the conversations name.
TOOLS = {
    "search": {
        "type": "object", "required": ["query", "limit"], "additionalProperties": False,
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}},
    },
    "note": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string"}}},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations whose assistant turns call a tool with the turn's text, answered by the user's next turn.

    By a hash of the text a call waits for the call before it or after it, names an unknown function, or has a limit
    that is no whole number. A user's turn that follows no assistant's answers a call that was never made.
    """
    text = F.coalesce("text", F.lit(""))
    salt = F.crc32(text.cast("binary")).cast("long")
    call = lambda turn: F.concat_ws("-", F.lit("call"), "conv_id", turn)
    size = F.size(F.split(text, " "))
    arguments = F.to_json(F.struct(
        text.alias("query"), F.when(salt % 7 == 0, F.concat(size.cast("string"), F.lit("x"))).alias("bad"),
        F.when(salt % 7 != 0, size).alias("limit"),
    ))
    arguments = F.when(salt % 7 == 0, F.regexp_replace(arguments, '"bad":', '"limit":')).otherwise(arguments)
    name = F.when(salt % 11 == 0, "forget").when(salt % 2 == 0, "note").otherwise("search")
    after = F.when(salt % 4 == 0, F.array(call(F.col("turn") - 2))).when(salt % 16 == 1, F.array(call(F.col("turn") + 2)))
    made = F.to_json(F.struct(F.array(F.struct(
        call(F.col("turn")).alias("id"), F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"),
        F.coalesce(after, F.array().cast("array<string>")).alias("after"),
    )).alias("tool_calls")))
    answer = F.to_json(F.struct(call(F.col("turn") - 1).alias("tool_call_id"), text.alias("content")))
    role = F.when((F.col("role") == "user") & (F.col("turn") > 0), "tool").otherwise(F.col("role"))
    body = F.when(role == "assistant", made).when(role == "tool", answer).otherwise(text)
    return conversations.select("conv_id", "turn", role.alias("role"), body.alias("text"))


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.link_tool_calls(tool_messages(table(spark, folder, "conversations")), TOOLS)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, folder, "documents"), WORD_TOKENIZER, END_ID)


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.report(table(spark, folder, "documents"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.report(table(spark, folder, "embeddings"))


def minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.near_groups(table(spark, folder, "documents"))


def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(lexical.build_index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


QUERIES = {
    "op1_language_id": language_id,
    "op2_jaccard_join": jaccard_join,
    "op3_exact_dedup": exact_dedup,
    "op4_byte_bpe": byte_bpe,
    "op5_chat_formatting": chat_formatting,
    "op6_token_files": token_files,
    "op7_personal_data": personal_data,
    "op8_quality_classifier": quality_classifier,
    "op9_substring_dedup": substring_dedup,
    "op10_benchmark_decontamination": decontamination,
    "op11_minhash_near_dedup": minhash_near_dedup,
    "op12_lexical_search": lexical_search,
    "op13_vector_codes": vector_codes,
}

NORMALISED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"



def lloyd_sql(rounds: int = codes.ROUNDS) -> str:
    """Lloyd's rounds as plain SQL: all distances, nearest entries, floors of means; one CTE for each round."""
    nearest = """n{k} as (
            select v, p, arg_min(e, (gap, e)) as e, min(gap) as gap from (
                select v, p, e, sum((x - c) * (x - c)) as gap from x join b{k} using (p, d) group by v, p, e)
            group by v, p)"""
    moved = """b{next} as (
            select b{k}.p, b{k}.e, b{k}.d, coalesce(((s - ((s % n) + n) % n) // n)::bigint, c) as c
            from b{k} left join (select p, e, d, sum(x) as s, count(*) as n from x join n{k} using (v, p) group by p, e, d)
            using (p, e, d))"""
    steps = [s.format(k=k, next=k + 1) for k in range(rounds) for s in (nearest, moved)]
    return f"""
        with kept as (
            select row_number() over (order by vec_id nulls last, embedding) - 1 as v, * from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        x as (
            select v, (spot * {codes.PARTS}) // width as p, spot % (width // {codes.PARTS}) as d, x from (
                select v, unnest(range(len(embedding))) as spot, len(embedding) as width,
                       floor({codes.SCALE} * unnest(embedding)::double)::bigint as x from kept)),
        b0 as (select p, v as e, d, x as c from x where v < {codes.ENTRIES}),
        {", ".join(steps)}, {nearest.format(k=rounds)},
        coded as (
            select v, string_agg(format('{{:02x}}', e), '' order by p) as code, sum(gap)::bigint as error from n{rounds} group by v)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
               (select sha256(string_agg(c::varchar, ',' order by p, e, d)) from b{rounds}) as codebooks_sha256
        from coded join kept using (v)
    """


def components_sql(words: int, percent: int, more: str = "") -> str:
    """Shingle sets, all pairs that share a shingle, their links, and what is reachable through them."""
    return rf"""
        with recursive words as (
            select doc_id, place, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from (select doc_id, text, row_number() over () as place from documents)),
        shingles as (
            select distinct doc_id, place, array_to_string(w[k:k + {words - 1}], ' ') as s from (
                select *, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) as k from words where len(w) > 0)),
        sizes as (select place, count(*) as n from shingles group by place),
        common as (
            select a.place as a, b.place as b, count(*) as c from shingles a join shingles b
            on a.s = b.s and a.place != b.place and a.doc_id is not null and b.doc_id is not null group by all),
        links as (
            select a, b from common join sizes x on x.place = a join sizes y on y.place = b
            where 100 * c >= {percent} * (x.n + y.n - c)),
        reach(place, other) as (
            select place, place from words union select place, b from reach join links on a = other),
        lowest as (select r.place, min(w.doc_id) as component_id from reach r join words w on w.place = r.other group by r.place)
        select doc_id, coalesce(n, 0) as n_shingles, component_id{more}
        from words join lowest using (place) left join sizes using (place)
    """


ORACLE = {
    "op2_jaccard_join": components_sql(jaccard.WORDS, jaccard.PERCENT),
    "op11_minhash_near_dedup": components_sql(sketches.WORDS, sketches.PERCENT, ", doc_id is not distinct from component_id as kept"),
    "op13_vector_codes": lloyd_sql(),
    "op12_lexical_search": r"""
        with words as (
            select doc_id, place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from (select doc_id, text, row_number() over () as place from documents)),
        lengths as (select place, any_value(doc_id) as doc_id, count(*) as n from words group by place),
        size as (select count(*) as docs, sum(n)::bigint as terms from lengths),
        strata as (select place, doc_id, 75 + (25 * n * docs) // terms as m from lengths, size),
        tfs as (select place, term, count(*) as tf from words group by place, term),
        weights as (
            select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from tfs, size group by term, docs),
        items as (
            select q, any_value(item_id) as item_id, term, count(*) as times from (
                select q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                from (select *, row_number() over () as q from benchmark)) group by q, term),
        scored as (
            select q, any_value(item_id) as item_id, place, any_value(doc_id) as doc_id,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
            from items join weights using (term) join tfs using (term) join strata using (place) group by q, place)
        select item_id, row_number() over (partition by q order by score desc, doc_id nulls last)::int as rank, doc_id, score
        from scored where score > 0 qualify rank <= 20
    """,
    "op3_exact_dedup": f"""
        with t as (select doc_id, length(coalesce(text, '')) as n, sha256({NORMALISED}) as sha from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by sha) as group_size,
               doc_id is not distinct from first_value(doc_id) over w and n = first_value(n) over w as kept, sha as text_sha256
        from t window w as (partition by sha order by n desc, doc_id nulls last)
    """,
    "op10_benchmark_decontamination": r"""
        with words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        items as (
            select item_id::varchar as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
        windows as (
            select distinct item_id, least(len(w), 13) as size, array_to_string(w[k:k + least(len(w), 13) - 1], ' ') as words
            from (select *, unnest(range(1, len(w) - least(len(w), 13) + 2)) as k from items where len(w) > 0)),
        sizes as (select distinct size from windows),
        hits as (
            select p.doc_id, p.k, p.size, x.item_id
            from (select doc_id, size, unnest(range(1, len(w) - size + 2)) as k, w from words, sizes where len(w) >= size) p
            join windows x on x.size = p.size and x.words = array_to_string(p.w[p.k:p.k + p.size - 1], ' ')),
        places as (
            select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(k, k + size)) as spot from hits)
            group by doc_id),
        named as (
            select doc_id, count(distinct item_id) as n_items,
                   string_agg(distinct item_id, ',' order by item_id) as names from hits group by doc_id)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(names, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
        from words left join places using (doc_id) left join named using (doc_id)
    """,
}
