"""SQL with the results of the registered queries, for DuckDB; values are written out, not imported.

Without SQL, and tested against brute force instead: op1 (a seeded agenda of merges), op4 (groups of
near copies: all pairs of sets are too slow on whole tables), op6 (a trained classifier), op7 (archive
files), op8 (a probabilistic filter), op9 (all strings of 200 bytes).
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_EXACT = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
           from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""


def _contamination() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return rf"""
with d as (select doc_id, {words} as w from documents),
b as (select item_id, {words} as w from benchmark),
windows as (
    select distinct cast(item_id as varchar) as item, least(13, len(w)) as size,
           array_to_string(w[k : k + least(13, len(w)) - 1], ' ') as win
    from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k from b where len(w) > 0)),
sizes as (select distinct size from windows),
places as (
    select doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') as win
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as p from d, sizes where len(w) >= size)),
hits as (select distinct doc_id, item, p, size from places join windows using (size, win)),
hit_words as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(p, p + size)) as word from hits) group by doc_id),
runs as (
    select doc_id, item, p, k, k + size as past
    from (select distinct doc_id, item, k, p, size from (
        select h.doc_id, w2.item, w2.k, w2.size, h.p from (select distinct doc_id, p, size from hits) h
        join places using (doc_id, p, size)
        join (select item_id as item, k, least(13, len(w)) as size, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') as win
              from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k from b where len(w) > 0)) w2 using (size, win)))),
longest as (
    select doc_id, item, min(p) - 1 as spot, max(past) - min(k) as words
    from (select *, p - row_number() over (partition by doc_id, item, p - k order by p) as run from runs)
    group by doc_id, item, p - k, run
    qualify row_number() over (partition by doc_id order by max(past) - min(k) desc, min(p), item) = 1),
items as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
          from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated,
       coalesce(words, 0) as longest_words, coalesce(spot, -1) as longest_at, cast(longest.item as varchar) as longest_item
from d left join hit_words using (doc_id) left join items using (doc_id) left join longest using (doc_id)
"""


def _urls(depth: int = 3, differ: float = 3.84, weight: int = 20, purity: float = 0.8) -> str:
    levels = range(1, depth + 1)
    shape = ", ".join(f"coalesce(regexp_replace(parts[{k}], '[0-9]+', '#', 'g'), '') as s{k}" for k in levels)
    key = ", ".join(["host", *[f"s{k}" for k in levels], "tail"])
    steps = ""
    name = "replace(replace(replace(replace(step, '*', '%2A'), '{', '%7B'), '|', '%7C'), '}', '%7D')"
    for k in levels:
        last = f"tree{k - 1}"
        steps += f"""
branches{k} as (select host, template, s{k} as step, sum(labelled) as labelled, sum(bad) as bad from {last} group by all),
named{k} as (
    select *, bad / labelled as rate, {name} as name from branches{k}
    where step <> '' and not contains(step, '#') and labelled > 0),
rates{k} as (
    select host, template, rate, cast(sum(labelled) as double) as labelled, cast(sum(bad) as double) as bad
    from named{k} group by host, template, rate),
cuts{k} as (
    select host, template, list_reduce(
        list({{'cuts': []::double[], 'rate': rate, 'labelled': labelled, 'bad': bad}} order by rate),
        lambda g, x: case when x.rate - g.bad / g.labelled > 0 and (x.rate - g.bad / g.labelled) * (x.rate - g.bad / g.labelled)
            >= {differ} * ((x.bad + g.bad) / (x.labelled + g.labelled)) * (1 - (x.bad + g.bad) / (x.labelled + g.labelled))
               * (1 / x.labelled + 1 / g.labelled)
            then {{'cuts': list_append(g.cuts, x.rate), 'rate': x.rate, 'labelled': x.labelled, 'bad': x.bad}}
            else {{'cuts': g.cuts, 'rate': x.rate, 'labelled': g.labelled + x.labelled, 'bad': g.bad + x.bad}} end).cuts as cuts
    from rates{k} group by host, template),
groups{k} as (
    select n.host, n.template, step, name, len(list_filter(cuts, lambda c: c <= rate)) as alike
    from named{k} n join cuts{k} c on n.host = c.host and n.template = c.template),
names{k} as (
    select host, template, unnest(steps) as step,
           case when len(names) = 1 then '/' || names[1]
                when len(names) <= 100 then '/{{' || array_to_string(names, '|') || '}}'
                else '/{{' || names[1] || '|' || len(names) || ' names|' || names[-1] || '}}' end as branch
    from (select host, template, alike, list_sort(list(name)) as names, list(step) as steps from groups{k} group by all)),
tree{k} as (
    select t.* replace (t.template || coalesce(branch, case when s{k} = '' then '' else '/*' end) as template)
    from {last} t left join names{k} m on t.host = m.host and t.template = m.template and t.s{k} = m.step),"""
    return rf"""
with parts as (
    select page_id, case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end as rest from pages),
paths as (
    select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') as host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from parts),
lists as (select *, list_filter(string_split(path, '/'), lambda s: s <> '') as parts from paths),
split as (select page_id, host, path, {shape}, case when len(parts) > {depth} then '**' else '' end as tail from lists),
told as (select doc_id, min(quality) as good from labels where quality is not null and doc_id is not null group by doc_id),
tree0 as (
    select {key}, count(*) as n, count(good) as labelled, count(*) filter (good = 0) as bad, '' as template
    from split left join told on page_id = doc_id group by {key}),{steps}
tree as (select * replace (template || case when tail = '' then '' else '/**' end as template) from tree{depth}),
total as (select coalesce((sum(labelled) - sum(bad)) / nullif(sum(labelled), 0), 1.0) as overall from tree0),
judged as (
    select host, template, sum(labelled) as all_labelled,
           (sum(labelled) - sum(bad) + {weight} * any_value(overall)) / (sum(labelled) + {weight}) as purity
    from tree, total group by host, template),
ruled as (
    select split.*, template, all_labelled, purity,
           case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
                when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
                when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
                when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
                when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
    from split join tree using ({key}) join judged using (host, template))
select page_id, host, path, rule,
       case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
            when purity < {purity} then 'block' else 'allow' end as verdict,
       template, cast(all_labelled as bigint) as labelled, round(purity, 6) as purity
from ruled
"""


def _licenses() -> str:
    from trendloom.llm.license_texts import KNOWN

    marks = "“”„‘’‚«»–—―…•·"

    def canonical(text: str) -> str:
        out = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
        out = f"regexp_replace({out}, '(^|\\n)[ \\t\\r*#/;-]*(copyright|copr\\.|\\(c\\)|©|all rights reserved)[^\\n]*', chr(10), 'g')"
        out = f"regexp_replace(translate({out}, '{marks}', '{' ' * len(marks)}'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')"
        for old, new in (
            ("licence", "license"), ("licencing", "licensing"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"),
            ("https", "http"), ("organis", "organiz"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
            ("judgement", "judgment"), ("analogue", "analog"), ("per cent", "percent"), ("copy right", "copyright"),
            ("merchantibility", "merchantability"), ("version v", "version "),
        ):
            out = f"replace({out}, '{old}', '{new}')"
        return f"sha256(trim({out}, ' '))"

    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in KNOWN)
    return f"""
with known as (
    select {canonical('text')} as digest, string_agg(distinct license_id, '|' order by license_id) as license_id
    from (values {known}) k(license_id, text) group by 1),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from documents),
named as (
    select doc_id, string_agg(distinct license_id, ',' order by license_id) as statements
    from (select doc_id, {canonical('line')} as digest from lines) join known using (digest) group by doc_id),
whole as (select doc_id, {canonical('text')} as canonical_sha256 from documents)
select doc_id, canonical_sha256, license_id, statements
from whole left join known on canonical_sha256 = digest left join named using (doc_id)
"""


_MIX = r"""
with d as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
           substr(sha256('mix:' || coalesce(cast(doc_id as varchar), sha256(text), '')), 1, 15) as hash
    from documents),
s as (
    select source, sum(size) as source_size, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
    from d group by source),
-- Sources that stop soonest come first; each is compared with what those before it leave.
tried as (
    select *, (select sum(source_size) from s) - coalesce(sum(3 * source_size) over before, 0) as words,
           (select sum(weight) from s) - coalesce(sum(weight) over before, 0) as rest
    from s window before as (order by 3.0 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
stop as (
    select (select sum(source_size) from s) - coalesce(sum(3 * source_size), 0) as words,
           (select sum(weight) from s) - coalesce(sum(weight), 0) as rest
    from tried where weight * words > 3 * source_size * rest),
t as (
    select source, cast(source_size as bigint) as source_size,
           case when rest = 0 then 3.0 * source_size
                else least(cast(weight * words as double) / cast(rest as double), cast(3 * source_size as double)) end as target
    from s, stop),
w as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from t),
n as (select *, target - whole * source_size as need from w),
h as (select source, hash, sum(size) as words from d group by source, hash),
r as (select *, coalesce(sum(words) over (partition by source order by hash rows between unbounded preceding and 1 preceding), 0) as above from h),
edge as (
    select n.source, hash, (need - above) * 2 >= words as last_too from r join n on r.source is not distinct from n.source
    where above < need and need <= above + words)
select doc_id, size, source_size, target, cast(whole + more as bigint) as copies, cast(size * (whole + more) as bigint) as taken
from (
    select d.doc_id, size, source_size, target, whole,
           case when edge.hash is null then 0 when d.hash < edge.hash or (d.hash = edge.hash and last_too) then 1 else 0 end as more
    from d join n on d.source is not distinct from n.source left join edge on d.source is not distinct from edge.source)
"""

_RESAMPLE = rf"""
with bytes as (select range as b from range(256)),
table_ as (
    select list(crc order by b) as crcs
    from (select b, list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as crc from bytes)),
d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents),
corpus as (select doc_id, unnest(words) as word from d),
wanted as (select unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
known as (select distinct word from corpus union select distinct word from wanted),
spelt as (select word, hex(encode(word)) as digits from known),
hashed as (
    select word, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(len(digits) // 2), lambda k:
            (position(digits[2 * k + 1] in '0123456789ABCDEF') - 1) * 16 + position(digits[2 * k + 2] in '0123456789ABCDEF') - 1)),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from spelt, table_),
s as (select bucket, count(*) as s from corpus join hashed using (word) group by bucket),
t as (select bucket, count(*) as t from wanted join hashed using (word) group by bucket),
gains as (
    select bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::double) * ((select count(*) from corpus) + 10000)
                                   / ((s + 1.0::double) * ((select count(*) from wanted) + 10000)))) as gain
    from s left join t using (bucket)),
sums as (select doc_id, sum(gain) as weight from corpus join hashed using (word) join gains using (bucket) group by doc_id),
noisy as (
    select doc_id, len(words) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
           cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as h
    from d left join sums using (doc_id)),
scored as (
    select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score from noisy),
ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select doc_id, cast(n_features as bigint) as n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join ranked using (doc_id)
"""


def _codes(rounds: int = 2) -> str:
    gap = "list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = ""
    for k in range(rounds + 1):
        steps += f"""
away{k} as (select v.id, v.p, b.e, {gap} as away from v join book{k} b using (p)),
found{k} as (select id, p, min(away) as away, arg_min(e, (away, e)) as e from away{k} group by id, p),"""
        if k < rounds:
            steps += f"""
mean{k} as (
    select p, e, list(total // n - case when total % n < 0 then 1 else 0 end order by i) as x
    from (select p, e, i, sum(x[i]) as total, count(*) as n from (select v.*, e, unnest([1, 2, 3, 4]) as i from v join found{k} using (id, p)) group by p, e, i)
    group by p, e),
book{k + 1} as (select p, e, coalesce(m.x, b.x) as x from book{k} b left join mean{k} m using (p, e)),"""
    return f"""
with kept as (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as whole
    from embeddings
    where embedding is not null and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))),
whole as (select row_number() over (order by vec_id, whole) as id, * from kept),
v as (select id, p, whole[4 * p + 1 : 4 * p + 4] as x from (select id, whole, unnest(range(16)) as p from whole)),
book0 as (select p, id - 1 as e, x from v where id <= 64),{steps}
digest as (
    select sha256(string_agg(line, ',' order by p, e)) as codebooks_sha256
    from (select p, e, array_to_string(list_transform(x, lambda c: cast(c as varchar)), ',') as line from book{rounds})),
coded as (select id, string_agg(lower(printf('%02x', cast(e as int))), '' order by p) as code, cast(sum(away) as bigint) as error from found{rounds} group by id)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join whole using (id), digest
"""


ORACLES = {
    "op2_license_scans": _licenses(),
    "op3_url_filters": _urls(),
    "op5_exact_dedup": _EXACT,
    "op10_benchmark_decontamination": _contamination(),
    "op11_source_mixing": _MIX,
    "op12_importance_resampling": _RESAMPLE,
    "op13_vector_codes": _codes(),
}
