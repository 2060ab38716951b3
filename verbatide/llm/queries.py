"""One query per operator, with production parameters, over the whole tables."""

from pyspark.sql import functions as F

from verbatide.llm import automaton_dedup as A
from verbatide.llm import decontaminate as D
from verbatide.llm import dual_tree as C
from verbatide.llm import itq as Q
from verbatide.llm import langid_cnn as L
from verbatide.llm import mixing as M
from verbatide.llm import packing as P
from verbatide.llm import periodic_runs as R
from verbatide.llm import simhash_vptree as V
from verbatide.llm import suffix_dedup as S
from verbatide.llm import token_counts as T
from verbatide.llm import url_reputation as U
from verbatide.llm import warc as W
from verbatide.llm.registry import ORACLES, QUERIES, query, table
from verbatide.storage import scratch_path

__all__ = ["ORACLES", "QUERIES"]

BASE32_SQL = "||".join(
    f"substr('{W.BASE32}', (((('0x'||substr(h,{i},5))::int) >> {s}) & 31) + 1, 1)"
    for i in range(1, 41, 5)
    for s in (15, 10, 5, 0)
)


@query(
    "op3_warc",
    f"""with p as (select page_id, encode(coalesce(html, '')) as b from pages),
    d as (select page_id, octet_length(b)::bigint as n, sha1(b) as h,
        min(page_id) over (partition by sha1(b)) as first from p)
    select page_id, n as payload_bytes, {BASE32_SQL} as payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to from d""",
)
def op3(spark, sf_dir):
    path = scratch_path(spark, "warc")
    W.archive_pages(table(spark, sf_dir, "pages"), path, least=0)
    return W.archived_pages(spark, path)


@query("op6_token_counts")
def op6(spark, sf_dir):
    import public_tokenizers

    return T.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )


# The url filter's rules: verdict, host and path.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def labelled_outcomes(spark, sf_dir):
    """(host, bad) of pages whose url ends in the number of a labelled document.

    Bad means toxic or of low quality. Labels are reduced to one row per document.
    """
    labels = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    )
    pages = table(spark, sf_dir, "pages").select(
        U.url_host(F.col("url")).alias("host"),
        F.regexp_extract(U.url_path(F.col("url")), "/([0-9]{1,18})[^0-9/]*/?$", 1)
        .try_cast("long")
        .alias("doc_id"),
    )
    return pages.join(labels, "doc_id").select("host", F.col("bad").cast("int").alias("bad"))


def _level_sql(name, rows, parent):
    """Posterior means of one level: rows (..., n, bad, parent), strength by moments."""
    spread = "n * pow(bad / n - parent, 2) / greatest(parent * (1 - parent), 1e-9)"
    return f"""{name}_in as ({rows}),
    {name}_m as (select coalesce(sum({spread}), 0) s, coalesce(sum(n), 0) n,
        coalesce(sum(n * n), 0) n2, count(*) k from {name}_in),
    {name}_f as (select *, n - n2 / greatest(n, 1) - (k - 1) as free from {name}_m),
    {name}_s as (select least(greatest(1 / greatest(case when free > 0
        then (s - (k - 1)) / free else 0 end, 1e-6) - 1, 1.0), 1000.0) as st from {name}_f),
    {name} as (select i.*, (st * parent + bad) / (st + n) as mean, st + n as total
        from {name}_in i, {name}_s)"""


_TWO_SQL = ", ".join(f"'{s}'" for s in U.TWO_LABEL_SUFFIXES)


def _parts_sql(source):
    """``source`` (..., host) with its registered domain and its suffix."""
    return f"""(select *, array_to_string(labels[-least(kept + 1, len(labels)):], '.') as domain,
        array_to_string(labels[-kept:], '.') as suffix from (select *, case when len(labels) > 1
        and array_to_string(labels[-2:], '.') in ({_TWO_SQL}) then 2 else 1 end as kept
        from (select *, string_split(host, '.') as labels from {source})))"""


def _bound_sql(level):
    return f"{level}.mean - 1.645 * sqrt({level}.mean * (1 - {level}.mean) / ({level}.total + 1))"


URL_SQL = rf"""with l as (select doc_id, max((coalesce(toxic, 0) = 1 or coalesce(quality, 1) = 0)::int) bad
        from labels group by 1),
    u as (select page_id, url,
        lower(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')) as host,
        coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages),
    o as (select host, l.bad from u join l on l.doc_id =
        try_cast(regexp_extract(path, '/([0-9]{{1,18}})[^0-9/]*/?$', 1) as bigint) where host <> ''),
    hosts as (select host, domain, suffix, count(*)::double n, sum(bad)::double bad
        from {_parts_sql("o")} group by all),
    domains as (select domain, suffix, sum(n) n, sum(bad) bad from hosts group by all),
    suffixes as (select suffix, sum(n) n, sum(bad) bad from domains group by all),
    {_level_sql("a", "select *, (select sum(bad) / sum(n) from suffixes) as parent from suffixes", "")},
    {_level_sql("b", "select d.*, a.mean as parent from domains d join a using (suffix)", "")},
    {_level_sql("c", "select h.*, b.mean as parent from hosts h join b using (domain)", "")},
    j as (select page_id, p.host, path,
        coalesce({_bound_sql("c")}, {_bound_sql("b")}, {_bound_sql("a")}) as bound,
        [r for r in [{", ".join(f"{{'v': '{v}', 'r': '{r}'}}" for v, r in sorted(URL_RULES, key=lambda r: -len(r[1])))}]
            if ('.' || p.host) like '%.' || regexp_extract(r.r, '^[^/]*')
            and starts_with(path, regexp_extract(r.r, '/.*$'))][1] as hit
        from {_parts_sql("u")} p left join c on p.host = c.host left join b on p.domain = b.domain
        left join a on p.suffix = a.suffix)
    select page_id, host, path, hit.r as rule,
    coalesce(hit.v, case when bound > 0.5 then 'block' else 'allow' end) as verdict from j"""


@query("op10_url_reputation", URL_SQL)
def op10(spark, sf_dir):
    return U.judge_urls(
        table(spark, sf_dir, "pages"), labelled_outcomes(spark, sf_dir), URL_RULES
    ).select("page_id", "host", "path", "rule", "verdict")


@query("op9_simhash_vptree")
def op9(spark, sf_dir):
    return V.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4, seed=42)


@query("op7_itq")
def op7(spark, sf_dir):
    return Q.embedding_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def _covered_sql(symbols, windows):
    """Places ``p`` of each document with their symbol, and whether a window that a
    smaller doc_id has covers them; ``windows`` gives (doc_id, p, w)."""
    return f"""windows as ({windows}),
    firsts as (select w, min(doc_id) as first from windows group by w),
    found as (select doc_id, p, true as again from windows join firsts using (w)
        where doc_id > first),
    places as (select s.doc_id, s.p, s.symbol, coalesce(max(f.again::int) over (
        partition by s.doc_id order by s.p rows between 49 preceding and current row), 0) = 1
        as gone from ({symbols}) s left join found f using (doc_id, p)),
    marked as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p),
        false) as opens from places)"""


BYTES_SQL = f"""with docs as (select doc_id, encode(coalesce(text, '')) as b from documents),
    {_covered_sql(
        "select doc_id, p, hex(b[p + 1 : p + 1]) as symbol from docs, range(0, octet_length(b)::bigint) t(p)",
        "select doc_id, p, b[p + 1 : p + 50] as w from docs, range(0, (octet_length(b) - 49)::bigint) t(p)",
    )}
    select doc_id, count(m.p)::bigint as n_bytes, count(*) filter (m.gone)::bigint as n_removed,
    count(*) filter (m.opens)::bigint as n_spans,
    sha256(unhex(coalesce(string_agg(m.symbol, '' order by m.p) filter (not m.gone), '')))
        as kept_sha256
    from docs left join marked m using (doc_id) group by doc_id"""


@query("op2_suffix_dedup", BYTES_SQL)
def op2(spark, sf_dir):
    return S.remove_repeats(table(spark, sf_dir, "documents"), window=50)


WORDS_SQL = rf"""with docs as (select doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
    {_covered_sql(
        "select doc_id, p, ws[p + 1] as symbol from docs, range(0, len(ws)::bigint) t(p)",
        "select doc_id, p, md5(array_to_string(ws[p + 1 : p + 50], ' ')) as w from docs, range(0, (len(ws) - 49)::bigint) t(p)",
    )}
    select doc_id, count(m.p)::bigint as n_words, count(*) filter (m.gone)::bigint as n_removed,
    sha256(coalesce(string_agg(m.symbol, ' ' order by m.p) filter (not m.gone), ''))
        as kept_sha256
    from docs left join marked m using (doc_id) group by doc_id"""


@query("op5_automaton_dedup", WORDS_SQL)
def op5(spark, sf_dir):
    return A.remove_repeated_passages(table(spark, sf_dir, "documents"), window=50).drop("kept")


@query("op8_langid_cnn")
def op8(spark, sf_dir):
    return L.identify(table(spark, sf_dir, "documents"))


@query("op1_string_tiling")
def op1(spark, sf_dir):
    return D.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least=5, coverage=0.5
    )


# Target shares of tokens by domain.
MIX_WEIGHTS = {"good": 0.92, "low": 0.06, "toxic": 0.02}


def label_domains(labels):
    """(doc_id, domain): toxic before low before good; without quality or toxic, null."""
    return labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 0, "low")
        .when(F.col("quality") == 1, "good")
        .alias("domain"),
    )


@query("op4_soft_mixing")
def op4(spark, sf_dir):
    labels = label_domains(table(spark, sf_dir, "labels"))
    mixed = M.mix(table(spark, sf_dir, "documents"), labels, MIX_WEIGHTS)
    return mixed.drop("place")

@query("op12_packing")
def op12(spark, sf_dir):
    import public_tokenizers

    packed = P.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=2048
    )
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _nearest_sql(name, book):
    """Each part's nearest entry of ``book``, ties to the lower index."""
    return f"""{name} as (select vec_id, label, k, x, min({{'d': far, 'j': j}}) as hit from (
        select p.vec_id, p.label, p.k, p.x, b.j, list_inner_product(p.x, p.x)
        - 2 * list_inner_product(p.x, b.c) + list_inner_product(b.c, b.c) as far
        from p join {book} b on p.k = b.k) group by all)"""


def _renewed_sql(name, hits, book):
    """The entries of ``book`` as floored means of their parts; unused ones stay."""
    return f"""{name}_s as (select k, hit.j as j, i, floor(sum(x[i]) / count(*)) as m
        from {hits}, range(1, (select max(len(x)) + 1 from p)) t(i) group by all),
    {name}_l as (select k, j, list(m order by i) as c from {name}_s group by all),
    {name} as (select b.k, b.j, coalesce(l.c, b.c) as c from {book} b
        left join {name}_l l on b.k = l.k and b.j = l.j)"""


CODES_SQL = f"""with v as (select vec_id, label, [floor(256 * x::double) for x in embedding] as z
        from embeddings where embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    p as (select vec_id, label, k, z[(k * len(z) // 16 + 1)::bigint : ((k + 1) * len(z) // 16)::bigint] as x
        from v, range(16) t(k)),
    b0 as (select k, row_number() over (partition by k order by vec_id) - 1 as j, x as c
        from p where vec_id in (select vec_id from v order by vec_id limit 64)),
    {_nearest_sql("h0", "b0")}, {_renewed_sql("b1", "h0", "b0")},
    {_nearest_sql("h1", "b1")}, {_renewed_sql("b2", "h1", "b1")},
    {_nearest_sql("h2", "b2")},
    r as (select vec_id, label, string_agg(printf('%02x', hit.j), '' order by k) as code,
        sum(hit.d)::bigint as error from h2 group by all),
    digest as (select sha256(string_agg(array_to_string([y::bigint for y in c], ','), ',' order by k, j))
        as h from b2)
    select vec_id, label, code, error, sum(error) over (partition by label)::bigint as label_error,
    (select h from digest) as codebooks_sha256 from r"""


@query("op13_dual_tree_codes", CODES_SQL)
def op13(spark, sf_dir):
    return C.vector_codes(table(spark, sf_dir, "embeddings"), parts=16, size=64, scale=256, rounds=2)


RUNS_SQL = r"""with t as (select list(list_reduce(list_prepend(i, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
        from range(256) r(i)),
    h as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
        xor(list_reduce(list_prepend(4294967295::bigint,
            [ascii(x)::bigint for x in string_split(doc_id::varchar, '')]),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h from documents, t),
    g as (select doc_id, ws, h % 10 = 0 and len(ws) > 0 as planted, len(ws) as n,
        (h // 10) % greatest(len(ws), 1) as a, 3 + (h // 10) % 8 as c from h),
    w as (select doc_id, p, ws[case when planted and p >= a
        then a + (p - a) % (1 + (n - a) // c) else p end + 1] as w from g, range(0, n) t(p)),
    e as (select x.doc_id, x.p, y.p - x.p as q from w x join w y
        on x.doc_id = y.doc_id and x.w = y.w and y.p > x.p),
    i as (select *, p - row_number() over (partition by doc_id, q order by p) as i from e),
    s as (select doc_id, q, min(p) as start, count(*) + q as length from i group by doc_id, q, i),
    r as (select doc_id, start, length, min(q) as period from s
        where length >= 12 and length >= 2 * q group by all),
    k as (select w.doc_id, w.p, w.w, count(r.start) = 0 as kept from w left join r
        on w.doc_id = r.doc_id and w.p >= r.start + r.period and w.p < r.start + r.length group by all),
    c as (select doc_id, string_agg(w, ' ' order by p) filter (kept) as text from k group by 1),
    b as (select doc_id, count(*) as n, max({'l': length, 's': -start, 'p': -period}) as top,
        string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as runs
        from r group by 1)
    select g.doc_id, coalesce(b.n, 0)::bigint as n_runs, (-top.s)::bigint as start,
    top.l::bigint as length, (-top.p)::bigint as period,
    (1000 * top.l // -top.p)::bigint as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256,
    sha256(coalesce(c.text, '')) as collapsed_sha256
    from g left join b using (doc_id) left join c using (doc_id)"""


def with_planted_runs(docs):
    """(doc_id, text): of one document in ten, by its number's CRC-32, the words from a
    place on repeat those that follow it. Null doc_id: as it is."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words",
        F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))),
    )
    sized = words.withColumn("g", F.expr("h div 10")).withColumn("n", F.expr("nullif(size(words), 0)"))
    placed = sized.withColumn("a", F.expr("cast(g % n as int)")).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")
    )
    planted = F.expr(
        "concat_ws(' ', slice(words, 1, a),"
        " slice(flatten(array_repeat(slice(words, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a))"
    )
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", RUNS_SQL)
def op11(spark, sf_dir):
    found = R.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")), least=12)
    best = F.expr(
        "array_max(transform(runs, r -> struct(r.length as l, -r.start as s, -r.period as p)))"
    )
    lines = F.expr(r"concat_ws('', transform(runs, r -> concat_ws(',', r.start, r.length, concat(r.period, '\n'))))")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
