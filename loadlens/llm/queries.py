"""Registered queries of this subpackage and, where SQL can say it, their counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import alignment, fingerprints, language, packing, phrases, pieces, pii, quality, secrets, setsketch, url_filter, vectors, warc
from loadlens.llm.tables import table


def op2_warc_index_merge(spark: SparkSession, sf: str) -> DataFrame:
    return warc.digest(warc.archive(table(spark, sf, "pages")))


def op3_stable_hash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf, "embeddings"))


def op4_setsketch_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf, "documents"))


def op1_hyperdimensional_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))


def op5_markov_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages").select("page_id", "url")).drop("url")


def op6_fourier_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_sentencepiece_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Piece ids of every document, and whether their decoding is the text again (null: empty)."""
    rows = pieces.round_trip(table(spark, sf, "documents"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op8_bottom_k_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.digest(fingerprints.edited_fingerprints(table(spark, sf, "documents")))


def op9_cost_balanced_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf, "documents")))


def op10_entropy_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf, "documents").select("doc_id", "text")))


def op11_pair_bitmap_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents"))


def op12_weak_label_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.scan(table(spark, sf, "documents").select("doc_id", "text")))


def op13_prefix_free_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hyperdimensional_language_id": op1_hyperdimensional_language_id,
    "op2_warc_index_merge": op2_warc_index_merge,
    "op3_stable_hash_near_dedup": op3_stable_hash_near_dedup,
    "op4_setsketch_near_dedup": op4_setsketch_near_dedup,
    "op5_markov_url_filter": op5_markov_url_filter,
    "op6_fourier_quality": op6_fourier_quality,
    "op7_sentencepiece_round_trip": op7_sentencepiece_round_trip,
    "op8_bottom_k_fingerprints": op8_bottom_k_fingerprints,
    "op9_cost_balanced_packing": op9_cost_balanced_packing,
    "op10_entropy_secrets": op10_entropy_secrets,
    "op11_pair_bitmap_alignment": op11_pair_bitmap_alignment,
    "op12_weak_label_pii": op12_weak_label_pii,
    "op13_prefix_free_collocations": op13_prefix_free_collocations,
}


def _url_oracle(order: int = url_filter.ORDER) -> str:
    """The rules and the two Witten-Bell models in SQL, order by order."""
    start, end = url_filter.START, url_filter.END
    fits = lambda h, p: f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    ranked = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    pick = lambda value: "case " + " ".join(f"when {fits(r[1], r[2])} then '{value(r)}'" for r in ranked) + " end"
    levels = []
    for k in range(1, order + 1):
        context = f"partition by left(gram, {k - 1})"
        seen = ", ".join(f"sum({c}) over ({context}) as n_{c}, sum(({c} > 0)::int) over ({context}) as t_{c}" for c in ("allow", "block"))
        low = "1.0::double / width" if k == 1 else "b.p_{c}"
        p = ", ".join(
            f"case when n_{c} > 0 then ({c} + t_{c} * {low.format(c=c)}) / (n_{c} + t_{c}) else {low.format(c=c)} end as p_{c}" for c in ("allow", "block")
        )
        levels.append(f"""
        g{k} as materialized (select right(gram, {k}) as gram, sum(allow)::double as allow, sum(block)::double as block from counted group by 1),
        s{k} as (select gram, allow, block, {seen}, count(*) over ({context}) as width from g{k}),
        l{k} as materialized (select s.gram, {p} from s{k} s {"" if k == 1 else f"join l{k - 1} b on b.gram = right(s.gram, {k - 1})"})""")
    return rf"""
        with split as (select page_id, coalesce(url, '') as text, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1) as h,
          regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) as path from pages),
        parsed as materialized (select page_id, text, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from split),
        ruled as materialized (select *, {pick(lambda r: r[1] + r[2])} as rule, {pick(lambda r: r[0])} as ruled from parsed),
        texts as materialized (select text, any_value(ruled) as ruled, left(md5(text), 1) in ('0', '1', '2') as held from ruled group by text),
        rows as materialized (select text, ruled, held, substr(padded, i, {order}) as gram from
          (select *, unnest(range(1, length(padded) - {order - 2})) as i from (select *, concat('{start * (order - 1)}', text, '{end}') as padded from texts))),
        counted as materialized (select gram, sum((coalesce(ruled, '') = 'allow' and not held)::int) as allow,
          sum((coalesce(ruled, '') = 'block' and not held)::int) as block from rows group by 1),{",".join(levels)},
        scores as materialized (select text, any_value(ruled) as ruled, any_value(held) as held, avg(ln(p_allow) - ln(p_block)) as raw
          from rows join l{order} using (gram) group by text),
        known as (select count(*) filter (where ruled = 'allow' and not held) > 0 and count(*) filter (where ruled = 'block' and not held) > 0 as ok,
          avg(round(raw, 6)) filter (where ruled = 'allow' and held) as a, greatest(stddev_pop(round(raw, 6)) filter (where ruled = 'allow' and held), 1e-6) as sa,
          avg(round(raw, 6)) filter (where ruled = 'block' and held) as b, greatest(stddev_pop(round(raw, 6)) filter (where ruled = 'block' and held), 1e-6) as sb
          from scores)
        select page_id, host, path, rule, coalesce(r.ruled, case when case when ok then round(raw, 6) else 0 end
            >= case when ok and a is not null and b is not null then (a * sb + b * sa) / (sa + sb) else 0 end then 'allow' else 'block' end) as verdict,
          case when ok then round(raw, 6) else 0 end as score
        from ruled r join scores using (text), known"""


ORACLES: dict[str, str] = {
    "op5_markov_url_filter": _url_oracle(),
    "op2_warc_index_merge": r"""
        with sized as (select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest, url from pages),
        first as (select digest, min(page_id) as first from sized where n >= 100 group by 1 having count(*) > 1 and min(page_id) is not null),
        rest as (select page_id, regexp_replace(lower(coalesce(url, '')), '^[^/?#]*?://|#(.|\n)*$', '', 'g') as rest from sized),
        keyed as (select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_extract(rest, '^[^/?]*'), '^.*@', ''), ':[0-9]*$', ''),
          '^www\.', '') as host, regexp_replace(rest, '^[^/?]*', '') as path from rest)
        select s.page_id, s.n as payload_bytes, s.digest as payload_digest,
          case when f.first <> s.page_id then 'revisit' else 'response' end as record_type,
          case when f.first <> s.page_id then f.first end as refers_to,
          concat(array_to_string(list_reverse(string_split(k.host, '.')), ','), ')', k.path) as url_key
        from sized s left join first f on f.digest = s.digest join keyed k on k.page_id = s.page_id""",
    "op3_stable_hash_near_dedup": """
        with recursive usable as materialized (
          select vec_id, label, embedding::double[] as v from embeddings where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as materialized (select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
          and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.93),
        reach as (select vec_id, vec_id as other from embeddings union select r.vec_id, l.b from reach r join links l on l.a = r.other),
        counts as (select a as vec_id, count(*) as n from links group by 1)
        select e.vec_id, coalesce(c.n, 0) as n_links, r.component_id, e.vec_id = r.component_id as kept
        from embeddings e join (select vec_id, min(other) as component_id from reach group by 1) r on r.vec_id = e.vec_id
        left join counts c on c.vec_id = e.vec_id""",
    "op4_setsketch_near_dedup": """
        with recursive words as materialized (
          select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') as w from documents),
        shingles as materialized (
          select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as s
          from words where w is not null),
        sizes as materialized (select doc_id, count(*) as n from shingles group by 1),
        links as materialized (
          select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
          join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
          group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
        reach as (select doc_id, doc_id as other from documents union select r.doc_id, l.b from reach r join links l on l.a = r.other)
        select d.doc_id, coalesce(z.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
        from documents d join (select doc_id, min(other) as component_id from reach group by 1) c on c.doc_id = d.doc_id
        left join sizes z on z.doc_id = d.doc_id""",
    "op13_prefix_free_collocations": r"""
        with texts as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from texts),
        words as materialized (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
        grams as (select lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as phrase from words, (values (1), (2), (3)) as sizes(k)),
        counts as materialized (select lang, k, phrase, count(*) as f from grams group by all),
        totals as (select lang, sum(f) as n from counts where k = 1 group by lang),
        cuts as (select c.lang, c.k, c.phrase, c.f as a, cut, array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') as first,
          array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ') as rest from counts c, (values (1), (2)) as t(cut) where c.k > cut and c.f >= 10),
        scored as materialized (select cuts.lang, cuts.k, cuts.phrase, a, cut, x.f as l, y.f as r,
          cast((1000000::hugeint * a * a) // (x.f::hugeint * y.f) as bigint) as score
          from cuts join counts x on x.lang = cuts.lang and x.phrase = first and x.k = cut
          join counts y on y.lang = cuts.lang and y.phrase = rest and y.k = cuts.k - cut),
        best as materialized (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        inner_parts as (select distinct b.lang, b.phrase from best b join best c on c.lang = b.lang and c.k = 3 and b.k = 2
          and (array_to_string(string_split(c.phrase, ' ')[1:2], ' ') = b.phrase or array_to_string(string_split(c.phrase, ' ')[2:3], ' ') = b.phrase)
          and 100 * c.a >= 50 * b.a),
        kept as (select * from best b where not exists (select 1 from inner_parts i where i.lang = b.lang and i.phrase = b.phrase))
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, cast(n as bigint) as n, score
        from kept join totals using (lang) qualify rank <= 2000""",
}
