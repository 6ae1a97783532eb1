"""The queries of the operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm import (
    bpe,
    chat,
    decontam,
    idfile,
    jaccard,
    langid,
    lexical,
    neardup,
    personal,
    runs,
    secretscan,
    urlfilter,
    warc,
)
from cdcmart.llm.common import run_folder, saved


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary files are; another place is given to the operators as a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to token ids and back."""
    return bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near-duplicates and its links."""
    return jaccard.join_similar(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return langid.report(_table(spark, sf_dir, "documents"))


def op4_chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against the same one with another reply, as prompt and masked completions."""
    return chat.report(_table(spark, sf_dir, "conversations"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page to WARC archives and back."""
    return warc.report(_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every window of the benchmark."""
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links by cosine and its component."""
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written in key order and read back."""
    docs = _table(spark, sf_dir, "documents")
    folder = run_folder(spark, "op8")
    idfile.write_ids(docs, f"{folder}/ids", tokenizer_file("word_bpe_49k.json"))
    # Read once more than needed otherwise: the sums per file, and the rows.
    found = saved(idfile.read_ids(spark, f"{folder}/ids"), folder, "read")
    return idfile.with_starts(found).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


# The rules that every page is judged by: host, path, action.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by its rule, or by its equivalents'."""
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets; ``source`` is the owner, each document a repository."""
    return secretscan.report(_table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data, in disguise too."""
    return personal.report(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of repeated words, a tenth of the documents made periodic first."""
    return runs.report(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_chat_pairs": op4_chat_pairs,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_near_vectors": op7_near_vectors,
    "op8_id_files": op8_id_files,
    "op9_url_filter": op9_url_filter,
    "op10_secrets": op10_secrets,
    "op11_personal_data": op11_personal_data,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
}

# Words of a text: A-Z lower-cased, then runs of digits, letters and all that is not ASCII.
_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _form(url: str) -> str:
    """The canonical form of a url as SQL."""
    host = _LOWER.format(f"regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's')")
    path = f"regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
    query = f"'?' || regexp_extract({url}, '^[^?#]*[?]([^#]*)', 1, 's')"
    kept = f"regexp_replace(regexp_replace({query}, '([?&])((utm_[a-z]+|gclid|fbclid)=[^&]*(&|$))+', '\\1', 'g'), '[?&]+$', '')"
    return f"case when contains({url}, '://') then '//' || {host} || regexp_replace({path}, '/+$', '') || {kept} end"


def _span_sql(kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one kind as SQL: the texts between the matches give the positions."""
    quoted = pattern.replace("'", "''")
    return f"""
        select doc_id, source, '{kind[1:]}' as kind, {kind[0]} as nth, v as value, s, s + length(m) as e from (
            select doc_id, source, found[k] as m, vals[k] as v,
                   cast(list_sum([length(x) for x in gaps[1 : k]])
                        + coalesce(list_sum([length(x) for x in found[1 : k - 1]]), 0) as bigint) as s
            from (select doc_id, source, string_split_regex(text, '{quoted}') as gaps,
                         regexp_extract_all(text, '{quoted}', 0) as found,
                         regexp_extract_all(text, '{quoted}', {group}) as vals
                  from documents where regexp_matches(text, '{quoted}')) x,
                 range(1, len(found) + 1) t(k)) y
        where length(v) >= {least}"""


SQL: dict[str, str] = {
    "op4_chat_pairs": """
        with turns as (
            select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as n
            from (select distinct conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text
                  from conversations where conv_id is not null)),
        replies as (select conv_id, max(n) filter (role = 'assistant') as place from turns group by conv_id),
        reply as (select conv_id, role, text from turns join replies using (conv_id) where n = place),
        other as (
            select conv_id, role, text, row_number() over (partition by conv_id order by n) as n from (
                select turns.conv_id, n,
                       case when n = place then reply.role else turns.role end as role,
                       case when n = place then reply.text else turns.text end as text
                from turns join replies using (conv_id) left join reply on reply.conv_id = xor(turns.conv_id, 1)) x
            where role is not null),
        cut as (
            select conv_id, coalesce(min(n) filter (not same) - 1, max(n)) as shared from (
                select coalesce(turns.conv_id, other.conv_id) as conv_id, coalesce(turns.n, other.n) as n,
                       coalesce(turns.role = other.role and turns.text = other.text, false) as same
                from turns full join other on turns.conv_id = other.conv_id and turns.n = other.n) x
            group by conv_id),
        sides as (select 'one' as side, * from turns union all select 'other', * from other),
        texts as (
            select side, conv_id, n, shared, role, '<|' || role || '|>' || chr(10) || text || chr(10) as t, length(role) + 5 as opening
            from sides join cut using (conv_id)),
        placed as (
            select *, cast(sum(case when n > shared then length(t) end)
                           over (partition by side, conv_id order by n) as bigint) as stop from texts),
        whole as (
            select side, conv_id, any_value(shared) as shared,
                   coalesce(string_agg(t, '' order by n) filter (n <= shared), '') as prompt,
                   coalesce(string_agg(t, '' order by n) filter (n > shared), '') as completion,
                   coalesce(string_agg(stop - length(t) + opening || ':' || stop, ',' order by n)
                            filter (n > shared and role = 'assistant'), '') as spans
            from placed group by side, conv_id)
        select one.conv_id as pair_id, one.conv_id as chosen_id, xor(one.conv_id, 1) as rejected_id,
               one.shared as n_prompt_turns, one.prompt, one.completion as chosen_text, one.spans as chosen_spans,
               coalesce(other.completion, '') as rejected_text, coalesce(other.spans, '') as rejected_spans
        from whole one left join whole other on other.conv_id = one.conv_id and other.side = 'other'
        where one.side = 'one'""",
    "op9_url_filter": f"""
        with recursive page as (
            select page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} as host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path,
                   {_form("url")} as form, url, html
            from pages),
        rules(rhost, rpath, action) as (values {", ".join(map(str, URL_RULES))}),
        ruled as (
            select page_id, host, path, form,
                   (select rhost || rpath || ' ' || action from rules
                    where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
                    order by length(rhost || rpath) desc, action limit 1) as best
            from page),
        judged as (select *, split_part(best, ' ', 1) as rule, split_part(best, ' ', 2) as action from ruled),
        tags as (
            select form, host, path, unnest(regexp_extract_all(html, '<(link|meta)\\b[^>]*>', 0, 'is')) as tag
            from page where form is not null and html is not null),
        target as (
            select form, host, path, case
                when regexp_matches(tag, '<link\\b.*\\brel\\s*=\\s*["'']?canonical\\b', 'is')
                    then regexp_extract(tag, '\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is')
                when regexp_matches(tag, '<meta\\b.*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b', 'is')
                    then regexp_extract(tag, '\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is') end as t
            from tags),
        link as (
            select form, 'http://' || host as site, path, to_,
                   case when starts_with(to_, '/') then to_ else case when starts_with(path, '/')
                        then regexp_replace(path, '[^/]*$', '') else '/' end || to_ end as below
            from (select *, regexp_replace(t, '&(amp|#38|#x26);', '&', 'gi') as to_ from target where t <> '') x),
        whole as (
            select form as a, case when regexp_matches(to_, '^[A-Za-z][A-Za-z0-9+.-]*://') then to_
                                   when regexp_matches(to_, '^[A-Za-z][A-Za-z0-9+.-]*:') or starts_with(to_, '#') then null
                                   when starts_with(to_, '//') then 'http:' || to_
                                   when starts_with(to_, '?') then site || path || to_
                                   else site || array_to_string(list_reduce(
                                            [[s] for s in string_split(regexp_extract(below, '^[^?#]*', 0, 's'), '/')],
                                            lambda a, s: case when s[1] = '.' or s[1] = '..' and len(a) = 1 then a
                                                           when s[1] = '..' then a[1 : len(a) - 1]
                                                           else list_concat(a, s) end), '/')
                                        || regexp_extract(below, '^[^?#]*(.*)$', 1, 's') end as w
            from link),
        edge as (select a, {_form("w")} as b from whole where w is not null),
        both_ways as (select a, b from edge union select b, a from edge),
        reach(a, b) as (
            select form, form from judged where form is not null
            union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
        ranks as (
            select reach.a as form, max(case action when 'allow' then 2 when 'block' then 1 end) as rank
            from reach join judged on judged.form = reach.b group by reach.a)
        select page_id, host, path, rule,
               coalesce(action, case when rank = 1 then 'block' else 'allow' end) as verdict
        from judged left join ranks using (form)""",
    "op10_secrets": f"""
        with base as materialized (
            {_span_sql("1assign", secretscan.ASSIGN, 2, 6)}
            union all {_span_sql("2access", secretscan.ACCESS, 0, 20)}
            union all {_span_sql("3hex", secretscan.HEX, 0, 24)}),
        live as (
            select value from base
            where length(value) >= 16 and regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')
            group by value having count(distinct coalesce(source, chr(1))) <= {secretscan.MAX_OWNERS}
                and count(distinct (coalesce(source, chr(1)), coalesce(doc_id, -1))) <= {secretscan.MAX_REPOSITORIES}),
        spans as (
            select doc_id, kind, nth, s, e from base
            union all
            select distinct doc_id, 'live', 4, e - length(value), e from base join live using (value)),
        listed as (
            select doc_id, string_agg(kind || ':' || s || ':' || e, ',' order by s, nth, e) as spans,
                   string_agg(kind || ':' || s || ':' || e, ',' order by s, nth, e) filter (nth < 4) as base,
                   count(*) filter (nth = 1) as n_assign, count(*) filter (nth = 2) as n_access,
                   count(*) filter (nth = 3) as n_hex, count(*) filter (nth = 4) as n_live
            from spans group by doc_id)
        select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
               coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
               coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live
        from documents left join listed using (doc_id)""",
    "op6_decontamination": f"""
        with doc as materialized (select doc_id, {_WORDS} as w from documents),
        item as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
        patterns as (
            select distinct item_id, least(10, len(w)) as m,
                   array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
            from item, range(1, len(w) - least(10, len(w)) + 2) t(i)
            where len(w) > 0),
        lengths as (select distinct m from patterns),
        windows as (
            select doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') as win
            from doc, lengths, range(1, len(w) - m + 2) t(i)),
        found as materialized (
            select doc_id, i, m, item_id from windows join patterns using (m, win)),
        hit as (
            select doc_id, count(distinct i + k) as n_hit
            from (select distinct doc_id, i, m from found), range(0, m) t(k) group by doc_id),
        hits as (
            select doc_id, count(distinct item_id) as n_items,
                   string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
            from found group by doc_id)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from doc left join hit using (doc_id) left join hits using (doc_id)""",
    "op13_ranked_search": f"""
        with doc as materialized (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
        sizes as (select cast(count(*) as bigint) as docs, cast(sum(len(w)) as bigint) as total from doc where len(w) > 0),
        held as materialized (
            select r, term, count(*) as tf from (select r, unnest(w) as term from doc) x group by r, term),
        item as (
            select item_id, term, count(*) as times
            from (select item_id, unnest(w) as term from (select distinct item_id, text, {_WORDS} as w from benchmark) y) x
            group by item_id, term),
        weights as (
            select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / (2 * count(*) + 1))) as bigint) as weight
            from held, sizes group by term),
        scores as (
            select item_id, doc.r, doc_id, cast(sum(times * weight * (
                (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(w) * docs) // total)))) as bigint) as score
            from item join weights using (term) join held using (term) join doc using (r), sizes
            group by item_id, doc.r, doc_id),
        ranked as (
            select item_id, doc_id, score,
                   row_number() over (partition by item_id order by score desc, doc_id nulls first) as rank
            from scores where score > 0)
        select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10""",
}
