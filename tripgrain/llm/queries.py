"""The operators as queries over the sample tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm import fingerprints
from tripgrain.llm.byte_bpe import decode_ids, encode_texts
from tripgrain.llm.columns import table
from tripgrain.llm.conversations import repair_conversations
from tripgrain.llm.decontaminate import find_contamination, is_contaminated
from tripgrain.llm.divergence import divergence
from tripgrain.llm.fingerprints import edited_neighbours, likeness
from tripgrain.llm.html_text import extract_text
from tripgrain.llm.licenses import scan_licenses
from tripgrain.llm.ngram_join import jaccard_classes
from tripgrain.llm.quality import fit_quality, grade_documents
from tripgrain.llm.simhash import as_hex, near_duplicates
from tripgrain.llm.suffix_index import readable, remove_repeats
from tripgrain.llm.token_counts import count_tokens
from tripgrain.llm.toxicity import fit_toxicity, score_documents

Query = Callable[[SparkSession, str], DataFrame]

MAX_TOKENS = 2048


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(documents, ranks, public_tokenizers.PATTERN).drop("text")
    return decode_ids(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the documents, as files `source/lang/doc_id`."""
    documents = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    scanned = scan_licenses(documents.select("doc_id", path.alias("path"), "text"))
    return scanned.drop("text")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract_text(table(spark, sf_dir, "pages"))
    return extracted.select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of the contract, and the text left, without characters that were cut in two."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.reduce(
        "spans",
        F.lit(0).cast("bigint"),
        lambda total, span: total + (span["end"] - span["start"]),
    )
    return remove_repeats(documents).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        readable(F.col("kept")).alias("text"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(documents, table(spark, sf_dir, "labels"))
    return grade_documents(documents, model).drop("text")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    compared = edited_neighbours(documents)
    return compared.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_hex(F.col("packed")).alias("fingerprint"),
        fingerprints.as_hex(F.col("packed_edited")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("packed_edited")).alias("near_edited"),
        likeness(F.col("packed"), F.col("packed_next")).alias("near_next"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")

    def is_held_out(doc_id: str) -> Column:
        return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0

    model = fit_toxicity(documents, labels.filter(~is_held_out("doc_id")))
    return score_documents(documents, model).select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with the damage that the query repairs; NULLs are one space."""
    read = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
        for name in ("conv_id", "turn", "role", "text")
    }
    key = F.concat(read["conv_id"], F.lit(":"), read["turn"]).cast("binary")
    damage = F.crc32(key) % 20
    text = F.when(damage == 1, "").when(damage == 2, F.translate(read["text"], ".!?", ""))
    copies = F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.filter(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(read["role"]).alias("role"),
        text.otherwise(read["text"]).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repairs = repair_conversations(damaged(conversations)).withColumnRenamed("conv_id", "repaired_id")
    every = conversations.select("conv_id").distinct()
    found = every.join(repairs, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_licenses": op2_licenses,
    "op3_simhash": op3_simhash,
    "op4_html_text": op4_html_text,
    "op5_decontamination": op5_decontamination,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_ngram_join": op11_ngram_join,
    "op12_source_divergence": op12_source_divergence,
    "op13_conversation_repair": op13_conversation_repair,
}

LOWER_WORDS_SQL = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION_SQL = f"""
    with docs as (select doc_id, {LOWER_WORDS_SQL} as words from documents),
    items as (select cast(item_id as varchar) as item, {LOWER_WORDS_SQL} as words from benchmark),
    windows as (
        select item, words, least(len(words), 13) as size,
               unnest(range(1, greatest(len(words) - 12, 1) + 1)) as pos
        from items where len(words) > 0),
    grams as (
        select distinct item, size, array_to_string(words[pos : pos + size - 1], ' ') as gram
        from windows),
    places as (
        select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as pos
        from docs, (select distinct size from grams) where len(words) >= size),
    hits as (
        select p.doc_id, p.pos, p.size, g.item
        from (select doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') as gram
              from places) as p
        join grams as g on g.size = p.size and g.gram = p.gram),
    covered as (
        select doc_id, count(distinct place) as n_hit
        from (select doc_id, unnest(range(pos, pos + size)) as place from hits) group by doc_id),
    found as (
        select doc_id, count(distinct item) as n_items,
               string_agg(distinct item, ',' order by item) as listed
        from hits group by doc_id)
    select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit,
           coalesce(n_items, 0) as n_items, sha256(coalesce(listed, '')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
    from docs left join covered using (doc_id) left join found using (doc_id)"""

DIVERGENCE_SQL = r"""
    with docs as (
        select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents),
    words as (select id, lang, source, unnest(terms) as term from docs),
    kept as (
        select lang, term, count(*) as lang_count from words
        group by lang, term having count(distinct id) >= 10),
    langs as (
        select lang, count(term) as V, coalesce(sum(lang_count), 0) as lang_total
        from (select distinct lang from docs) left join kept using (lang) group by lang),
    groups as (select distinct lang, source from docs),
    counts as (
        select g.lang, g.source, k.term, k.lang_count, coalesce(n, 0) as n
        from groups as g join kept as k using (lang)
        left join (select lang, source, term, count(*) as n from words group by all) as w
            using (lang, source, term)),
    totals as (select lang, source, sum(n) as total from counts group by all),
    shares as (
        select lang, source, term, n,
               1 + (1000000000 * (n::hugeint + 2)) // (total::hugeint + 2 * V) as p,
               1 + (1000000000 * (lang_count::hugeint + 2)) // (lang_total::hugeint + 2 * V) as q
        from counts join totals using (lang, source) join langs using (lang)),
    pairs as (
        select a.lang, a.source, b.source as item
        from groups as a join groups as b on a.lang = b.lang and a.source <> b.source),
    gaps as (
        select a.lang, a.source, b.source as item,
               sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
        from shares as a join shares as b on a.lang = b.lang and a.term = b.term
        where a.source <> b.source group by all),
    listed as (
        select lang, source, 'pair' as part, item, coalesce(value, 0)::bigint as value
        from pairs left join gaps using (lang, source, item)
        union all
        select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint
        from shares where n > 0 and p > q),
    ranked as (
        select *, (row_number() over (
            partition by lang, source, part order by value desc, item))::int as rank
        from listed)
    select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10"""


QUOTED_K, QUOTED_R, QUOTED_I = "'K'", "'R'", "'I'"


def _moved(value: str, cost: str, letters: str) -> str:
    """SQL of a value, ten digits of cost and the audit, after an edit; NULL stays NULL."""
    total = f"lpad((substr({value}, 1, 10)::bigint + {cost})::varchar, 10, '0')"
    return f"({total} || substr({value}, 11) || {letters})"


def _repair_step() -> str:
    """The columns of the next row's states: nothing, system, user, assistant, before inserts."""
    free = "case when fault = 'truncated' then 6 else 1 end"
    kept = "case when fault = 'truncated' then 5 else 0 end"

    def gone(state):
        return _moved(state, "2", "'D'")

    def moves(state, initial):
        keep = f"case when edit and initial = '{initial}' then {_moved(state, kept, QUOTED_K)} end"
        return f"{keep}, case when edit then {_moved(state, free, QUOTED_R)} end"

    return f"""
        {gone('n')} as n,
        least({gone('s')}, case when edit and initial = 's' then {_moved('n', kept, QUOTED_K)} end) as s,
        least({gone('u')}, {moves('n', 'u')}, {moves('s', 'u')}, {moves('a', 'u')}) as u,
        least({gone('a')}, {moves('u', 'a')}) as a"""


_U = f"least(u, {_moved('n', '5', QUOTED_I)}, {_moved('s', '5', QUOTED_I)}, {_moved('a', '5', QUOTED_I)})"
_A = f"least(a, {_moved('uu', '5', QUOTED_I)})"

REPAIR_SQL = rf"""
    with recursive crc_table as (
        select list_transform(range(256), lambda n: list_reduce(
            list_prepend(n, range(8)),
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as entries),
    keyed as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               list_transform(
                   string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                   lambda ch: ascii(ch)::bigint) as bytes
        from conversations),
    coded as (
        select *, xor(list_reduce(
            list_prepend(4294967295::bigint, bytes),
            lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 20 as damage
        from keyed, crc_table),
    rows_after as (
        select conv_id, turn, case when damage = 4 then 'user' else role end as role,
               case when damage = 1 then '' when damage = 2 then translate(text, '.!?', '')
                    else text end as text,
               unnest(range(case when damage = 3 then 2 else 1 end)) as copy
        from coded where damage <> 0),
    placed as (
        select *, substr(role, 1, 1) as initial,
               regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare,
               row_number() over (
                   partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos
        from rows_after),
    faulty as (
        select *,
               case when bare = '' then 'blank'
                    when row_number() over (partition by conv_id, role, text order by pos) > 1
                        then 'duplicate'
                    when right(bare, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
               lag(initial) over (partition by conv_id order by pos) as before
        from placed),
    stats as (
        select conv_id,
               coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (where fault = 'blank') as blank,
               count(*) filter (where fault = 'duplicate') as duplicate,
               count(*) filter (where fault = 'truncated') as truncated,
               count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au'))
                   as illegal,
               max(pos) as rows
        from faulty group by conv_id),
    derived as (
        select conv_id, 0::bigint as pos, '0000000000' as n, null::varchar as s,
               '0000000005I' as u, '0000000010II' as a
        from stats
        union all
        select conv_id, pos, n, s, uu, {_A}
        from (
            select conv_id, pos, n, s, {_U} as uu, a
            from (
                select d.conv_id, f.pos, {_repair_step()}
                from derived as d
                join (select *, fault not in ('blank', 'duplicate') as edit from faulty) as f
                    on f.conv_id is not distinct from d.conv_id and f.pos = d.pos + 1) as moved)
            as inserted),
    best as (
        select d.conv_id, substr(least(n, a), 1, 10)::bigint as cost,
               substr(least(n, a), 11) as audit
        from derived as d
        join stats as s on s.conv_id is not distinct from d.conv_id and d.pos = s.rows),
    letters as (
        select conv_id, unnest(string_split(audit, '')) as letter,
               unnest(range(1, len(audit) + 1)) as step
        from best where audit <> ''),
    taken as (
        select *, sum(case when letter = 'I' then 0 else 1 end) over (
                   partition by conv_id order by step rows unbounded preceding) as pos
        from letters),
    messages as (
        select t.conv_id, t.letter, t.step, f.role, f.text, f.initial,
               row_number() over (partition by t.conv_id order by t.step) as place
        from taken as t
        left join faulty as f on f.conv_id is not distinct from t.conv_id and f.pos = t.pos
            and t.letter <> 'I'
        where t.letter <> 'D'),
    leads as (
        select conv_id, max(case when place = 1 and letter = 'K' and initial = 's' then 1 else 0 end)
            as lead
        from messages group by conv_id),
    texts as (
        select m.conv_id,
               string_agg(
                   case when letter = 'K' then m.role
                        when (place - lead) % 2 = 1 then 'user' else 'assistant' end
                   || ':' || coalesce(m.text, ''), chr(10) order by place) as said
        from messages as m join leads as l on l.conv_id is not distinct from m.conv_id
        group by m.conv_id)
    select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
           coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
           coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
           sha256(coalesce(said, '')) as repaired_sha256
    from (select distinct conv_id from conversations) as c
    left join stats as s on s.conv_id is not distinct from c.conv_id
    left join best as b on b.conv_id is not distinct from c.conv_id
    left join texts as t on t.conv_id is not distinct from c.conv_id"""

# The other operators hash with functions that SQL lacks, train, or parse; they are tested against
# brute force, the public libraries or held-out labels.
ORACLES: dict[str, str] = {
    "op5_decontamination": DECONTAMINATION_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
    "op13_conversation_repair": REPAIR_SQL,
}
