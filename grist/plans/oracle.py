"""DuckDB SQL oracles, one per registered query (same column names).

Patterns come from the same constants the Spark side uses. The only
translation is ``\\d`` -> ``\\p{Nd}``: Python and Java (with ``(?U)``) read
``\\d`` as any Unicode decimal digit, RE2 reads it as ASCII.
"""

from __future__ import annotations

import re

from grist.functions import text as T
from grist.functions import treebank
from grist.operators import minhash as MH
from grist.operators import quality as Q

ORACLES: dict[str, str] = {}
NL = "chr(10)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    return lit(pattern.replace(r"\d", r"\p{Nd}"))


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def rx_replace(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {re2(pattern)}, {lit(repl)}, 'g')"


def rx_count(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {re2(pattern)}))::BIGINT"


# --- projections -------------------------------------------------------------

def mask_email_sql(e: str) -> str:
    return rx_replace(e, T.EMAIL_PATTERN, T.EMAIL_TOKEN)


def mask_phone_sql(e: str) -> str:
    return rx_replace(e, T.PHONE_PATTERN, T.PHONE_TOKEN)


def mask_ip_sql(e: str) -> str:
    return rx_replace(e, T.IP_PATTERN, T.IP_TOKEN)


def mask_pii_sql(e: str) -> str:
    return mask_ip_sql(mask_phone_sql(mask_email_sql(e)))


oracle("mask_emails", f"""
select doc_id, {mask_email_sql('text')} as masked, {rx_count('text', T.EMAIL_PATTERN)} as n_emails
from documents""")

oracle("mask_phones", f"""
select doc_id, {mask_phone_sql('text')} as masked, {rx_count('text', T.PHONE_PATTERN)} as n_phones
from documents""")

oracle("mask_ips", f"""
select doc_id, {mask_ip_sql('text')} as masked, {rx_count('text', T.IP_PATTERN)} as n_ips
from documents""")

MASK_STEPS_SQL = f"""
select *, {mask_ip_sql('t2')} as masked, {rx_count('t2', T.IP_PATTERN)} as n_ips
from (select *, {mask_phone_sql('t1')} as t2, {rx_count('t1', T.PHONE_PATTERN)} as n_phones
      from (select *, {mask_email_sql('text')} as t1,
                   {rx_count('text', T.EMAIL_PATTERN)} as n_emails
            from {{src}}) a) b"""

oracle("mask_pii", f"""
select doc_id, masked, n_emails, n_phones, n_ips
from ({MASK_STEPS_SQL.replace('{src}', 'documents')}) m""")

oracle("mask_conversations", f"""
select conv_id, turn, masked, n_emails, n_phones, n_ips
from ({MASK_STEPS_SQL.replace('{src}', 'conversations')}) m""")


def normalize_sql(e: str) -> str:
    punct = lit(T.PUNCTUATION)
    blanks = lit(" " * len(T.PUNCTUATION))
    s = f"translate(lower(strip_accents({e})), {punct}, {blanks})"
    return f"trim(regexp_replace({s}, {lit(T.WS + '+')}, ' ', 'g'))"


oracle("normalize_text", f"""
select doc_id, {normalize_sql('text')} as norm from documents""")


def shingle_list_sql(w: str, n: int) -> str:
    """``w`` must name a column: a lambda closing over an expression would
    re-evaluate it per element."""
    return (f"(case when len({w}) >= {n} then list_transform(range(0, len({w}) - {n} + 1), "
            f"lambda i: array_to_string({w}[i + 1:i + {n}], ' ')) else []::VARCHAR[] end)")


def shingles_sql(w: str, n: int) -> str:
    return f"list_sort(list_distinct({shingle_list_sql(w, n)}))"


def words_sql(src: str = "documents") -> str:
    return f"select doc_id, string_split({normalize_sql('text')}, ' ') as w from {src}"


oracle("shingles", f"""
select doc_id, len(sh)::BIGINT as n_shingles, sh as shingles
from (select doc_id, {shingles_sql('w', 2)} as sh from ({words_sql()}) x) s""")


def html_sql(e: str) -> str:
    s = e
    for pattern, repl in T.HTML_STEPS:
        r = repl.replace("\n", "\x00NL\x00").replace("\x01", "\x00B\x00")
        r = lit(r).replace("\x00NL\x00", "' || chr(10) || '").replace("\x00B\x00", "' || chr(1) || '")
        s = f"regexp_replace({s}, {lit(pattern)}, {r}, 'g')"
    # the references that the given pages hold; all others are tested in pytest
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                       ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")):
        s = f"replace({s}, {lit(entity)}, {lit(ch)})"
    for pattern, repl in T.HTML_TAIL_STEPS:
        r = lit(repl.replace("\n", "\x00NL\x00")).replace("\x00NL\x00", "' || chr(10) || '")
        s = f"regexp_replace({s}, {lit(pattern)}, {r}, 'g')"
    return f"replace({s}, chr(1), {lit(T.BULLET)})"


oracle("html_to_text", f"""
select page_id, {html_sql('html')} as text from pages""")

oracle("url_prefix", f"""
select page_id,
       {lit('https://mirror.example.org/crawl/')} ||
       regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$', 1), '^/', '')
       as fetch_url
from pages""")


# --- rules -------------------------------------------------------------------

def rule_stats_sql(e: str) -> str:
    return f"""
       {rx_count(e, T.WORD_TOKEN_PATTERN)} as n_words,
       length(regexp_replace({e}, {lit(T.WS)}, '', 'g'))::BIGINT as n_word_chars,
       {rx_count(e, Q.ALPHA_WORD_PATTERN)} as n_alpha_words,
       (len(string_split({e}, {NL})))::BIGINT as n_lines,
       len(list_filter(string_split({e}, {NL}), lambda l: suffix(l, '...')))::BIGINT
           as n_ellipsis_lines"""


def rule_failure_sql(p: str = "") -> str:
    return f"""case
         when {p}n_words < {T.MIN_WORDS} or {p}n_words > {T.MAX_WORDS} then 'word_count'
         when {p}n_word_chars < {p}n_words * {T.MIN_MEAN_LEN}
           or {p}n_word_chars > {p}n_words * {T.MAX_MEAN_LEN} then 'mean_word_length'
         when {p}n_ellipsis_lines * 10 > {p}n_lines * 3 then 'ellipsis_lines'
         when {p}n_alpha_words * 5 < {p}n_words * 4 then 'alphabetic_words'
       end"""


oracle("word_stats", f"""
select doc_id, n_words, n_word_chars, n_alpha_words
from (select doc_id, {rule_stats_sql('text')} from documents) s""")

oracle("line_stats", f"""
select doc_id, n_lines, n_ellipsis_lines
from (select doc_id, {rule_stats_sql('text')} from documents) s""")

oracle("gopher_filter", f"""
select doc_id, rule_failed, rule_failed is null as passes
from (select doc_id, {rule_failure_sql()} as rule_failed
      from (select doc_id, {rule_stats_sql('masked')}
            from (select doc_id, {mask_pii_sql('text')} as masked from documents) m) s) r""")


def treebank_sql(e: str) -> str:
    """The cascade of ``treebank.STEPS``; RE2 writes groups as ``\\1``."""
    for pattern, replacement in treebank.STEPS:
        e = rx_replace(e, pattern, re.sub(r"\$(\d)", r"\\\1", replacement))
    return e


def treebank_stats_sql(e: str) -> str:
    letters = f"regexp_replace({e}, {re2('[^' + chr(92) + 'p{L}' + T.WS_CLASS_BODY + ']+')}, '', 'g')"
    return f"""{rx_count(e, '[^' + T.WS_CLASS_BODY + ']+')} as n_words,
       length(regexp_replace({e}, {re2(T.WS)}, '', 'g'))::BIGINT as n_word_chars,
       {rx_count(letters, chr(92) + 'p{L}+')} as n_alpha_words"""


oracle("treebank_words", f"""
select doc_id, trim(regexp_replace(spaced, {re2(T.WS + '+')}, ' ', 'g')) as words, {treebank_stats_sql('spaced')}
from (select doc_id, {treebank_sql('text')} as spaced from documents) s""")

oracle("gopher_filter_treebank", f"""
with masked as (select doc_id, {mask_pii_sql('text')} as masked from documents),
spaced as (select doc_id, masked, {treebank_sql('masked')} as spaced from masked),
lines as (select doc_id, spaced, n_lines, n_ellipsis_lines from (select doc_id, spaced, {rule_stats_sql('masked')} from spaced) s),
stats as (select doc_id, n_lines, n_ellipsis_lines, {treebank_stats_sql('spaced')} from lines)
select doc_id, n_words, n_word_chars, n_alpha_words, {rule_failure_sql()} as rule_failed, ({rule_failure_sql()}) is null as passes from stats""")


# --- exact dedup -------------------------------------------------------------

LINES_SQL = f"""
select doc_id, pos::BIGINT as pos, line, pos < k as has_nl
from (select doc_id, unnest(p) as line, generate_subscripts(p, 1) as pos, len(p) as k
      from (select doc_id, string_split(text, {NL}) as p from documents) a) b
where not (pos = k and line = '')"""

oracle("line_explode", f"""
select doc_id, pos::INTEGER as pos, line, has_nl from ({LINES_SQL}) l""")

oracle("line_counts", f"""
select line, count(*)::BIGINT as n from ({LINES_SQL}) l group by line""")

oracle("exact_line_dedup", f"""
with l as ({LINES_SQL}),
c as (select line, count(*) as n from l group by line),
u as (select l.* from l join c using (line) where c.n = 1),
r as (select doc_id,
             string_agg(line || case when has_nl then {NL} else '' end, '' order by pos) as t
      from u group by doc_id)
select d.doc_id, coalesce(r.t, '') as text from documents d left join r using (doc_id)""")


def strip_nl_sql(e: str) -> str:
    return f"rtrim({e}, {NL})"


oracle("exact_doc_dedup", f"""
select min(doc_id) as doc_id, k as text
from (select doc_id, {strip_nl_sql('text')} as k from documents) a
group by k having count(*) = 1""")

oracle("exact_doc_dedup_first", f"""
select min(doc_id) as doc_id, k as text
from (select doc_id, {strip_nl_sql('text')} as k from documents) a
group by k""")


# --- fuzzy dedup -------------------------------------------------------------

def sets_sql(n: int, src: str = "documents") -> str:
    return f"select doc_id, {shingles_sql('w', n)} as sh from ({words_sql(src)}) x"


def sigs_sql(p: MH.MinHashParams, src: str = "documents") -> str:
    coeffs = MH.hash_coefficients(p.num_hashes, p.seed)
    mins = ", ".join(f"min(({a}::BIGINT * h + {b}) % {MH.PRIME})" for a, b in coeffs)
    return f"""
select doc_id, list_value({mins}) as sig
from (select doc_id, ('0x' || substr(md5(s), 1, 8))::BIGINT % {MH.PRIME} as h
      from ({sets_sql(p.ngrams, src)}) st, unnest(sh) as u(s)) hs
group by doc_id"""


def bands_sql(p: MH.MinHashParams, src: str = "documents") -> str:
    r = p.rows_per_band
    parts = " union all ".join(
        f"select doc_id, {j} as band, sig[{j * r + 1}:{j * r + r}] as key from sg"
        for j in range(p.num_bands))
    return f"with sg as ({sigs_sql(p, src)}) {parts}"


def edges_sql(p: MH.MinHashParams, src: str = "documents") -> str:
    return f"""
with b as ({bands_sql(p, src)}),
rt as (select band, key, min(doc_id) as root from b group by band, key having count(*) > 1)
select distinct rt.root as src, b.doc_id as dst from b join rt using (band, key)
where b.doc_id <> rt.root"""


def jaccard_sql(p: MH.MinHashParams) -> str:
    return f"""
with e as ({edges_sql(p)}), st as ({sets_sql(p.ngrams)}),
j as (select e.src, e.dst, len(list_intersect(a.sh, b.sh)) as i, len(a.sh) + len(b.sh) as t
      from e join st a on a.doc_id = e.src join st b on b.doc_id = e.dst)
select src, dst, case when t - i > 0 then i::DOUBLE / (t - i) end as jaccard from j"""


def components_sql(edges: str) -> str:
    return f"""
with recursive ed as ({edges}),
g(a, z) as (select src, dst from ed union select dst, src from ed),
r(id, x) as (select a, a from g union select r.id, g.z from r join g on g.a = r.x)
select id as vertex, min(x) as component from r group by id"""


def kept_sql(comp: str, src: str = "documents") -> str:
    return f"""
select doc_id from {src} kk
where doc_id not in (select vertex from ({comp}) c where vertex <> component)"""


def verified_edges_sql(p: MH.MinHashParams) -> str:
    """All pairs that share a bucket, by their similarity (not the operator's edges)."""
    return f"""
with b as ({bands_sql(p)}), st as ({sets_sql(p.ngrams)}),
pr as (select distinct x.doc_id as src, y.doc_id as dst from b x join b y using (band, key) where x.doc_id < y.doc_id)
select src, dst from pr join st a on a.doc_id = pr.src join st c on c.doc_id = pr.dst
where len(list_intersect(a.sh, c.sh)) > {p.jaccard_threshold} * (len(a.sh) + len(c.sh) - len(list_intersect(a.sh, c.sh)))"""


_MD = MH.MinHashParams(num_hashes=10, num_bands=2, ngrams=2, jaccard_threshold=0.8)
_MW = MH.MinHashParams(num_hashes=100, num_bands=10, ngrams=5, jaccard_threshold=0.8)

oracle("minhash_signature", sigs_sql(_MD))
oracle("minhash_signature_wide", sigs_sql(_MW))
oracle("lsh_bands", bands_sql(_MD))
oracle("lsh_edges", edges_sql(_MD))
oracle("jaccard_pairs", f"""
select src, dst, round(jaccard, 6) as jaccard, jaccard > {_MD.jaccard_threshold} as verified
from ({jaccard_sql(_MD)}) jj""")
oracle("minhash_dedup", kept_sql(components_sql(edges_sql(_MD))))
oracle("minhash_dedup_verified", kept_sql(components_sql(verified_edges_sql(_MD))))


def similar_sql(n: int, percent: int) -> str:
    """(src, dst): all pairs of documents, copies included, by shared shingles."""
    return f"""
with st as ({sets_sql(n)}), t as (select doc_id, len(sh) as m, unnest(sh) as s from st),
o as (select x.doc_id as src, y.doc_id as dst, any_value(x.m) + any_value(y.m) as m, count(*) as i
      from t x join t y using (s) where x.doc_id < y.doc_id group by all)
select src, dst from o where i * 100 >= (m - i) * {percent}"""


_SIMILAR = similar_sql(_MW.ngrams, 80)
_CLASSES = f"""select doc_id, case when len(sh) = 0 or sh is null then doc_id else min(doc_id) over (partition by sh) end as class_id
from ({sets_sql(_MW.ngrams)}) st"""
oracle("similar_documents", f"""
with p as ({_SIMILAR}), l as (select src as doc_id from p union all select dst from p),
n as (select doc_id, count(*) as n_links from l group by doc_id)
select doc_id, class_id, coalesce(n_links, 0)::BIGINT as n_links from ({_CLASSES}) c left join n using (doc_id)""")
oracle("similarity_dedup", kept_sql(components_sql(_SIMILAR)))
oracle("lsh_recall", f"""
with c as ({_CLASSES}), p as (select src, dst from ({_SIMILAR}) q
  where src in (select class_id from c) and dst in (select class_id from c)),
b as ({bands_sql(_MW)}), f as (select distinct src, dst from p join b x on x.doc_id = src join b y on y.doc_id = dst and x.band = y.band and x.key = y.key)
select (select count(*) from p) as n_pairs, (select count(*) from f) as n_found""")
oracle("minhash_dedup_wide", kept_sql(components_sql(edges_sql(_MW))))
oracle("duplicate_clusters", f"""
select component, count(*)::BIGINT as n_members
from ({components_sql(edges_sql(_MD))}) c group by component""")
oracle("dedup_report", f"""
with c as ({components_sql(edges_sql(_MD))})
select (select count(*) from documents) as n_before,
       (select count(*) from ({kept_sql('select * from c')}) k) as n_after,
       (select count(distinct component) from c) as n_clusters,
       (select count(*) from c where vertex <> component) as n_removed""")


# --- classifiers -------------------------------------------------------------

from grist.operators import classify as CL  # noqa: E402
from grist.operators import linear as LM  # noqa: E402
from grist.plans import curate as CU  # noqa: E402

LANGS = ["de", "en", "es", "fr"]


def feats_sql(src: str, key: str, text: str, f: CL.Featurizer) -> str:
    """(key, feats) with the featurizer's features; the word list is a column
    of an inner query so the bigram lambda does not re-evaluate it."""
    words = f"regexp_extract_all(lower(replace({text}, chr(10), {lit(f.newline)})), " \
            f"{lit(T.WORD_RUN_PATTERN)}, 0)"
    inner = f"select {key}, {words} as w from {src}"
    if f.bigrams:
        bi = ("list_transform(range(0, greatest(len(w) - 1, 0)), "
              "lambda i: w[i + 1] || ' ' || w[i + 2])")
        return f"select {key}, list_concat(w, {bi}) as feats from ({inner}) fw"
    return f"select {key}, w as feats from ({inner}) fw"


def nb_sql(train: str, classes: list[str], f: CL.Featurizer, score_src: str, prefix: str,
           text: str = "text") -> str:
    """CTE body scoring ``score_src(doc_id, <text>)`` with a head trained on
    ``train(label, text)``; yields doc_id, <prefix>_label, <prefix>_score."""
    k = len(classes)
    ns = ", ".join(f"sum(case when label = {lit(c)} then n else 0 end) as n_{i}"
                   for i, c in enumerate(classes))
    ts = ", ".join(f"sum(n_{i}) as t_{i}" for i in range(k))
    lps = ", ".join(f"ln((n_{i} + 1.0e0) / (t_{i} + 1.0e0 * v)) as lp_{i}" for i in range(k))
    pri = ", ".join(f"ln(count(*) filter (where label = {lit(c)}) * 1.0e0 / count(*)) as pr_{i}"
                    for i, c in enumerate(classes))
    sums = ", ".join(f"sum(lp_{i}) as s_{i}" for i in range(k))
    zs = ", ".join(f"(pr_{i} + coalesce(s_{i}, 0.0e0)) / (coalesce(m, 0) + 1.0e0) as z_{i}"
                   for i in range(k))
    zmax = f"greatest({', '.join(f'z_{i}' for i in range(k))})"
    lab = "case " + " ".join(f"when z_{i} = zmax then {lit(c)}" for i, c in enumerate(classes)) + " end"
    den = " + ".join(f"exp((z_{i} - zmax) * {CL.TEMPERATURE})" for i in range(k))
    return f"""
select doc_id, label as {prefix}_label, score as {prefix}_score from (
 with tr as ({train}),
 tf as (select label, ('0x' || substr(md5(f), 1, 5))::int as bucket
        from (select label, unnest(feats) as f from ({feats_sql('tr', 'label', 'text', f)}) x) u),
 cnt as (select bucket, label, count(*) as n from tf group by bucket, label),
 wide as (select bucket, {ns} from cnt group by bucket),
 tot as (select count(*) as v, {ts} from wide),
 model as (select bucket, {lps} from wide, tot),
 pri as (select {pri} from tr),
 sf as (select doc_id, ('0x' || substr(md5(f), 1, 5))::int as bucket
        from (select doc_id, unnest(feats) as f from ({feats_sql(score_src, 'doc_id', text, f)}) y) u),
 agg as (select doc_id, {sums}, count(lp_0) as m from sf join model using (bucket)
         group by doc_id),
 z as (select d.doc_id, {zs} from {score_src} d left join agg using (doc_id), pri),
 zz as (select *, {zmax} as zmax from z)
 select doc_id, {lab} as label, 1.0e0 / ({den}) as score from zz
) nb"""


LANG_TRAIN = "select lang as label, text from documents"


def binary_train(flag: str, pos: str, neg: str) -> str:
    return (f"select case when l.{flag} = 1 then {lit(pos)} else {lit(neg)} end as label, d.text "
            f"from documents d join labels l using (doc_id)")


NSFW_TRAIN = binary_train("toxic", "nsfw", "non-nsfw")
TOXIC_TRAIN = binary_train("toxic", "toxic", "non-toxic")
QUALITY_TRAIN = binary_train("quality", "high_quality", "low_quality")
NSFW_CLASSES = sorted(["nsfw", "non-nsfw"])
TOXIC_CLASSES = sorted(["toxic", "non-toxic"])
QUALITY_CLASSES = sorted(["high_quality", "low_quality"])


def lang_sql(src="documents", text="text"):
    return nb_sql(LANG_TRAIN, LANGS, CL.LANGUAGE_FEATURES, src, "lang", text)


def nsfw_sql(src="documents", text="text"):
    return nb_sql(NSFW_TRAIN, NSFW_CLASSES, CL.HARM_FEATURES, src, "nsfw", text)


def toxic_sql(src="documents", text="text"):
    return nb_sql(TOXIC_TRAIN, TOXIC_CLASSES, CL.HARM_FEATURES, src, "toxic", text)


def quality_sql(src="documents", text="text"):
    return nb_sql(QUALITY_TRAIN, QUALITY_CLASSES, CL.QUALITY_FEATURES, src, "quality", text)


def rounded(sql: str, prefix: str) -> str:
    return f"select doc_id, {prefix}_label, round({prefix}_score, 4) as {prefix}_score from ({sql}) r"


oracle("identify_language", rounded(lang_sql(), "lang"))
oracle("classify_nsfw", rounded(nsfw_sql(), "nsfw"))
oracle("classify_toxic", rounded(toxic_sql(), "toxic"))
oracle("classify_quality", rounded(quality_sql(), "quality"))

_qs = nb_sql(QUALITY_TRAIN, QUALITY_CLASSES, CL.QUALITY_FEATURES, "documents", "quality")
_model_only = _qs[_qs.index(" with tr as"):_qs.index(" pri as")].rstrip().rstrip(",")
oracle("train_quality_nb", f"""
select bucket, round(lp_0, 6) as lp_high, round(lp_1, 6) as lp_low from (
{_model_only}
 select * from model) mm""")



def linear_sql() -> str:
    """The linear model's gradient steps, one common table expression each."""
    f = CL.HARM_FEATURES

    def scaled(src: str, key: str) -> str:
        return f"""select {key}, bucket, floor(n / sqrt(sum(n * n) over (partition by {key})) * {LM.FEATURE} + 0.5e0)::BIGINT as x
         from (select {key}, ('0x' || substr(md5(f), 1, {CL.BUCKET_DIGITS}))::int as bucket, count(*) as n
               from (select {key}, unnest(feats) as f from ({feats_sql(src, key, 'text', f)}) a) b group by 1, 2) c
         union all select {key}, {CL.BUCKETS}, {LM.FEATURE} from {src}"""

    share = f"1.0e0 / (1.0e0 + exp(-(sum(x * coalesce(w, 0)) / ({LM.FEATURE}.0e0 * {LM.WEIGHT}.0e0))))"
    ctes = [f"""tr as materialized (select row_number() over () as r, text, quality as y,
              count(*) over () / (2.0e0 * count(*) over (partition by quality)) as balance, count(*) over () as n
         from documents join labels using (doc_id) where quality in (0, 1))""",
            f"tf as materialized ({scaled('tr', 'r')})",
            "w0 as (select distinct bucket, 0::BIGINT as w from tf)"]
    for i in range(LM.STEPS):
        ctes.append(f"""r{i} as materialized (select r, floor((p - y) * balance * {LM.WEIGHT} + 0.5e0)::BIGINT as rest, n
         from (select r, {share} as p from tf join w{i} using (bucket) group by r) p join tr using (r))""")
        ctes.append(f"""w{i + 1} as materialized (select bucket, w - floor(g::DOUBLE * {LM.RATE}e0 / n / {LM.FEATURE} + 0.5e0)::BIGINT as w
         from (select bucket, sum(rest * x) as g, any_value(n) as n from tf join r{i} using (r) group by bucket) g join w{i} using (bucket))""")
    return f"""
 with {", ".join(ctes)},
 sf as ({scaled('documents', 'doc_id')}),
 s as (select doc_id, {share} as p from sf left join w{LM.STEPS} using (bucket) group by doc_id)
 select doc_id, case when p > 0.5e0 then 'high_quality' else 'low_quality' end as quality_label, greatest(p, 1 - p) as quality_score from s"""


oracle("classify_quality_lr", rounded(linear_sql(), "quality"))

EN = f"lang_label = {lit(CU.ENGLISH_LABEL)} and lang_score > {CU.ENGLISH_MIN_SCORE}"
HARM = (f"(nsfw_label = 'nsfw' or nsfw_score < {CU.HARM_MIN_SCORE} "
        f"or toxic_label = 'toxic' or toxic_score < {CU.HARM_MIN_SCORE})")
HIGH = f"quality_label = {lit(CU.QUALITY_LABEL)} and quality_score >= {CU.QUALITY_MIN_SCORE}"

oracle("filter_english", f"select doc_id from ({lang_sql()}) s where {EN}")
oracle("filter_harmful", f"""
select doc_id from ({nsfw_sql()}) a join ({toxic_sql()}) b using (doc_id) where not {HARM}""")
oracle("filter_quality", f"select doc_id from ({quality_sql()}) s where {HIGH}")

oracle("coarse_filter", f"""
with st as (select doc_id, {rule_stats_sql('text')} from documents),
rf as (select doc_id, {rule_failure_sql()} as rule_failed from st),
a as ({lang_sql()}), b as ({nsfw_sql()}), c as ({toxic_sql()})
select doc_id, case
  when rule_failed is not null then 'rules'
  when lang_label <> 'en' or lang_score < {CU.COARSE_MIN_SCORE} then 'language'
  when nsfw_label <> 'non-nsfw' or nsfw_score < {CU.COARSE_MIN_SCORE} then 'nsfw'
  when toxic_label <> 'non-toxic' or toxic_score < {CU.COARSE_MIN_SCORE} then 'toxic'
end as coarse_reason
from rf join a using (doc_id) join b using (doc_id) join c using (doc_id)""")

MASKED_DOCS = f"(select doc_id, source, {mask_pii_sql('text')} as masked from documents)"
FUNNEL_SQL = f"""
with a as ({lang_sql()}),
b as ({nsfw_sql(MASKED_DOCS, 'masked')}), c as ({toxic_sql(MASKED_DOCS, 'masked')}),
q as ({quality_sql(MASKED_DOCS, 'masked')}),
st as (select doc_id, source, masked, {rule_stats_sql('masked')} from {MASKED_DOCS} md),
rf as (select doc_id, source, masked, {rule_failure_sql()} as rule_failed from st)
select doc_id, source, masked, case
  when not ({EN}) then 'non_en'
  when {HARM} then 'harmful'
  when rule_failed is not null then 'rules'
  when not ({HIGH}) then 'low_quality'
end as drop_reason
from rf join a using (doc_id) join b using (doc_id) join c using (doc_id) join q using (doc_id)"""

oracle("curate_stages", f"select doc_id, drop_reason from ({FUNNEL_SQL}) f")
oracle("curate", f"select doc_id, masked as text from ({FUNNEL_SQL}) f where drop_reason is null")
oracle("funnel_stats", f"""
select source, coalesce(drop_reason, 'kept') as outcome, count(*)::BIGINT as n
from ({FUNNEL_SQL}) f group by rollup (source, coalesce(drop_reason, 'kept'))""")

oracle("language_share", f"""
select lang_label, count(*)::BIGINT as n,
       round(count(*) * 1.0e0 / (select count(*) from documents), 6) as share
from ({lang_sql()}) s group by lang_label""")

KEPT_DOCS = f"(select doc_id, masked as text from ({FUNNEL_SQL}) f where drop_reason is null)"
oracle("curate_dedup", f"""
select k.doc_id, k.text from {KEPT_DOCS} k
where k.doc_id in ({kept_sql(components_sql(edges_sql(_MD, KEPT_DOCS)), KEPT_DOCS)})""")


# --- tokens and sampling -------------------------------------------------------

from grist.operators import sampling as SA  # noqa: E402
from grist.operators import tokens as TK  # noqa: E402
from grist.plans import queries as QQ  # noqa: E402

VOCAB_SQL = f"""
select token, id from (
 with t as (select unnest(regexp_extract_all(text, {lit(TK.TOKEN_PATTERN)}, 0)) as token
            from documents),
 c as (select token, count(*) as n from t group by token),
 top as (select token, n from c order by n desc, token limit {65536 - 257})
 select '<eos>' as token, 0::INTEGER as id
 union all select printf('<0x%02X>', range), (range + 1)::INTEGER from range(256)
 union all select token, (row_number() over (order by n desc, token) + 256)::INTEGER from top) v"""

ENCODE_SQL = f"""
select doc_id, ids from (
 with v as ({VOCAB_SQL}),
 tk as (select doc_id, regexp_extract_all(text, {lit(TK.TOKEN_PATTERN)}, 0) as tk from documents),
 t as (select doc_id, unnest(tk) as token, generate_subscripts(tk, 1) as pos from tk),
 e as (select doc_id, flatten(list(case when v.id is not null then [v.id]
                 else list_transform(regexp_extract_all(hex(token), '..', 0), lambda h: ('0x' || h)::INTEGER + 1) end
               order by pos)) as ids
       from t left join (select * from v where id > 256) v using (token) group by doc_id)
 select d.doc_id, list_concat(coalesce(e.ids, []::INTEGER[]), [0::INTEGER]) as ids
 from documents d left join e using (doc_id)) en"""

FLAT_SQL = f"""
select off + pos - 1 as g, id from (
 select off, unnest(ids) as id, generate_subscripts(ids, 1) as pos
 from (select ids, coalesce(sum(len(ids)) over (order by doc_id
              rows between unbounded preceding and 1 preceding), 0) as off
       from ({ENCODE_SQL}) e) l) t"""

PACK_SQL = f"""
select (g // {TK.CONTEXT})::BIGINT as seq, list(id order by g) as ids
from ({FLAT_SQL}) f group by 1"""

oracle("build_vocab", VOCAB_SQL)
oracle("encode_tokens", ENCODE_SQL)
oracle("token_count", f"select sum(len(ids))::BIGINT as n_tokens from ({ENCODE_SQL}) e")
oracle("pack_sequences", PACK_SQL)
oracle("decode_sequences", f"""
select seq, string_agg(case when x.id between 1 and 256 then printf('%02X', x.id - 1) else hex(v.token) end, '' order by pos) as hex
from (select seq, unnest(ids) as id, generate_subscripts(ids, 1) as pos from ({PACK_SQL}) p) x
left join ({VOCAB_SQL}) v using (id) group by seq""")
oracle("token_round_trip", "select doc_id, text from documents")

_B, _C, _S = QQ.WINDOW_BATCH, QQ.WINDOW_CTX, QQ.WINDOW_SEED
oracle("sample_training_windows", f"""
with t as ({FLAT_SQL}),
n as (select count(*) as l from t),
s as (select range as draw,
             ('0x' || substr(md5('{_S}:' || range::VARCHAR), 1, 12))::BIGINT % (l - {_C}) as start
      from range({_B}), n)
select draw, start,
       (select list(id order by g) from t where g >= start and g < start + {_C}) as x,
       (select list(id order by g) from t where g >= start + 1 and g < start + {_C} + 1) as y
from s""")

oracle("sample_k", f"""
select page_id, url from pages
order by md5('{SA.SAMPLE_SEED}:' || page_id::VARCHAR), page_id limit {QQ.URL_SAMPLE}""")

_K = f"md5('{SA.SAMPLE_SEED}:' || doc_id::VARCHAR)"
TRAINING_SQL = f"""
select rn, label, doc_id, line from (
 with cf as ({ORACLES['coarse_filter']}),
 pos as (select d.doc_id, d.text from documents d join labels l using (doc_id) where l.quality = 1),
 np as (select count(*) as c from pos),
 pool as (select * from (select d.doc_id, d.text, row_number() over (order by d.doc_id) as o
                         from documents d join labels l using (doc_id) where l.quality = 0) x, np
          where o <= {SA.NEGATIVE_POOL_FACTOR} * np.c),
 neg as (select * from (select doc_id, text, row_number() over (order by {_K}, doc_id) as o
                        from pool) y, np where o <= np.c),
 u as (select doc_id, text, '{SA.POSITIVE}' as label, '' as k from pos
       union all select doc_id, text, '{SA.NEGATIVE}', {_K} from neg),
 f as (select u.* from u join cf using (doc_id) where cf.coarse_reason is null),
 r as (select *, row_number() over (partition by label order by k, doc_id) as rn from f),
 m as (select case when count(*) < 2 then 0 else min(c) end as m
       from (select label, count(*) as c from f group by label) z)
 select rn::BIGINT as rn, label, doc_id,
        '{SA.LABEL_PREFIX}' || label || ' ' || replace(text, chr(10), ' ') as line
 from r, m where rn <= m.m) ts"""

oracle("balanced_training_set", TRAINING_SQL)
oracle("training_lines", f"select line from ({TRAINING_SQL}) t")
oracle("class_counts", f"select label, count(*)::BIGINT as n from ({TRAINING_SQL}) t group by label")
oracle("inspect_samples", f"""
select doc_id, outcome, rn from (
 select doc_id, coalesce(drop_reason, 'kept') as outcome,
        row_number() over (partition by coalesce(drop_reason, 'kept') order by {_K}, doc_id)::BIGINT
          as rn
 from ({FUNNEL_SQL}) f) x
where rn <= {QQ.INSPECT_PER_GROUP}""")


# --- audits ---------------------------------------------------------------------

PAGES_TEXT = f"(select page_id as doc_id, {html_sql('html')} as text from pages)"
PAGES_FLAT = f"(select doc_id, replace(text, chr(10), '') as text from {PAGES_TEXT} pt)"

oracle("pii_audit", f"""
select doc_id, masked, n_emails, n_phones, n_ips
from ({MASK_STEPS_SQL.replace('{src}', 'documents')}) m
where n_emails + n_phones + n_ips > 0""")
oracle("language_audit", f"""
select doc_id as page_id, lang_label, round(lang_score, 4) as lang_score
from ({lang_sql(PAGES_TEXT)}) a""")
oracle("harmful_audit", f"""
select doc_id as page_id, nsfw_label, round(nsfw_score, 4) as nsfw_score, toxic_label,
       round(toxic_score, 4) as toxic_score
from ({nsfw_sql(PAGES_FLAT)}) a join ({toxic_sql(PAGES_FLAT)}) b using (doc_id)""")
oracle("gopher_audit", f"""
select doc_id as page_id, rule_failed, rule_failed is null as passes
from (select doc_id, {rule_failure_sql()} as rule_failed
      from (select doc_id, {rule_stats_sql('text')} from {PAGES_TEXT} pt) s) r""")

oracle("validation_tokens", ENCODE_SQL.replace("from documents d left join e using (doc_id)",
                                               "from benchmark d left join e using (doc_id)")
       .replace("regexp_extract_all(text, " + lit(TK.TOKEN_PATTERN) + ", 0) as tk from documents",
                "regexp_extract_all(text, " + lit(TK.TOKEN_PATTERN) + ", 0) as tk from "
                "(select item_id as doc_id, text from benchmark) b")
       .replace("select d.doc_id, list_concat", "select d.item_id, list_concat")
       .replace("left join e using (doc_id)) en", "left join e on e.doc_id = d.item_id) en")
       .replace("select doc_id, ids from (", "select item_id, ids from ("))
