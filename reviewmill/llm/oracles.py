"""DuckDB SQL for the operators that SQL can express, written out from their definitions.

The others are tested against plain versions: trained models (2, 3), decoded keys (4), latent search (5), reachability
over sets (7), CRC-32 (9) and tokenizers (10, 11) have no DuckDB counterpart.
"""

from __future__ import annotations

# The scan: each block of 64 words, 32 apart, against each template; no index, no order, no filters.
OP1 = r"""
with templates(label, words) as (
    select label, list_distinct(string_split(notice, ' ')) from (values
        ('apache-2.0', 'licensed under the apache license version 2 0'),
        ('apache-2.0', 'you may not use this file except in compliance with the license you may obtain a copy of the license at'),
        ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
        ('cc-by-nc', 'licensed under cc by nc 4 0'),
        ('cc-by-nc', 'this work is licensed under a creative commons attribution noncommercial 4 0 international license'),
        ('cc-by-sa', 'licensed under cc by sa 4 0'),
        ('cc-by-sa', 'this work is licensed under a creative commons attribution sharealike 4 0 international license'),
        ('cc0', 'to the extent possible under law the author has waived all copyright and related or neighboring rights to this work'),
        ('gpl-3.0', 'this work is licensed under the gnu general public license version 3'),
        ('gpl-3.0', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license'),
        ('mit', 'released under the mit license'),
        ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
        ('mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0'),
        ('unlicense', 'this is free and unencumbered software released into the public domain')) as t(label, notice)),
docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
places as (
    select r, unnest(range(len(w))) as i, w from docs where list_has_any(w, ['cc', 'general', 'all'])),
found as (
    select r, i, case
        when w[i + 1] = 'cc' and w[i + 2] = 'by' then 'cc-by'
        when w[i + 1] = 'general' and w[i + 2] = 'public' and w[i + 3] = 'license' then 'gpl'
        when w[i + 1] = 'all' and w[i + 2] = 'rights' and w[i + 3] = 'reserved' then 'reserved' end as label
    from places),
base as (
    select r, count(*) as n, min(i) as first_word, max(i) as last_word, list_sort(list_distinct(list(label))) as labels
    from found where label is not null group by r),
blocks as (
    select r, unnest(range(greatest(1, (len(w) + 31) // 32))) as b, w from docs),
shares as (
    select r, label, len(list_intersect(t.words, list_distinct(w[b * 32 + 1 : b * 32 + 64]))) / len(t.words) as share, len(t.words) as n
    from blocks, templates t),
met as (
    select r, list_distinct(list(label)) as labels, max(share) as share from shares
    where round(share * n) >= ceil(round(0.9 * n, 9)) group by r)
select d.doc_id, len(w)::bigint as n_words, coalesce(base.n, 0)::bigint as n_base, first_word::bigint as first_word,
    last_word::bigint as last_word, coalesce(array_to_string(base.labels, ','), '') as base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ','), '') as labels,
    case when base.n > 0 then 1.0 else coalesce(met.share, 0.0) end::double as score
from docs d left join base using (r) left join met using (r)
"""

OP6 = r"""
with docs as (
    select row_number() over () as r, doc_id, source, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents),
windows as (
    select r, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] as g
    from (select r, w, unnest(range(len(w) - 2)) as i from docs where len(w) >= 3)),
repeated as (
    select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (
    select r, count(distinct i + k) as n from repeated, (values (0), (1), (2)) as t(k) group by r),
lines as (
    select r, count(*) as n, count(*) - count(distinct line) as repeats
    from (select r, unnest(string_split(text, chr(10))) as line from docs)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
counts as (
    select r, doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(lines.n, 0) as n_lines,
        coalesce(lines.repeats, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
    from docs left join lines using (r) left join covered using (r)),
rules as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, 10 * n_symbols > n_words as f1,
        10 * n_dup_lines > 3 * n_lines as f2, word_chars < 3 * n_words or word_chars > 10 * n_words as f3
    from counts),
failures as (
    select r, source, unnest([1, 2, 3]) as rule, unnest([f1, f2, f3]) as failed from rules),
hosts as (
    select rule, source, count(*) as docs, count(*) filter (failed) as failed from failures group by all),
moments as (
    select rule, avg(failed / docs) as mean, var_pop(failed / docs) as variance from hosts group by rule),
priors as (
    select rule, mean, case when variance = 0 then 1000.0
        else least(1000.0, greatest(1.0, mean * (1 - mean) / variance - 1)) end as prior from moments),
verdicts as (
    select rule, source, (failed + mean * prior) / (docs + prior) > 0.3 as bad from hosts join priors using (rule)),
judged as (
    select r, bool_or(failed and bad) as host_failed
    from failures f join verdicts v on f.rule = v.rule and f.source is not distinct from v.source group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
    not base_failed and not host_failed as kept
from rules join judged using (r)
"""

# Targets: sources whose cap is smallest for their weight stop first; the level is the first that stops no more.
OP8 = r"""
with sized as (
    select row_number() over () as r, doc_id, source, size, case when size > 0 then length(bin(size)) else 0 end + 8 as v
    from (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents)),
sources as (
    select source, sum(size)::bigint as source_size,
        ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight
    from sized group by source),
stops as (
    select *, sum(source_size) over () as total,
        coalesce(sum(source_size) over (order by source_size / weight, weight rows between unbounded preceding and 1 preceding), 0) as stopped,
        sum(weight) over (order by source_size / weight, weight rows between current row and unbounded following) as rest
    from sources),
levels as (
    select *, (total - 3 * stopped)::double / rest::double as level from stops),
level as (
    select min_by(level, source_size / weight) filter (3 * source_size >= weight * level) as level from levels),
targets as (
    select source, source_size, case when (3 * source_size)::double < weight * level then (3 * source_size)::double else weight * level end as target
    from sources, level),
classes as (
    select source, v, sum(size) as words from sized group by source, v having sum(size) > 0),
tried as (
    select c.source, v,
        (target - (3 * coalesce(sum(words) over (partition by c.source order by v desc rows between unbounded preceding and 1 preceding), 0))::double)
        / (sum(v * words) over (partition by c.source order by v desc rows between current row and unbounded following))::double as rate
    from classes c join targets t on c.source is not distinct from t.source),
rates as (
    select source, coalesce(max_by(rate, v) filter (rate * v <= 3), 3.0 / min(v)) as rate from tried group by source),
expected as (
    select s.*, source_size, target, least(3.0::double, coalesce(rate, 0.0) * v) as e,
        (('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':' || size || ':mix-1'), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
    from sized s join targets t on s.source is not distinct from t.source left join rates q on s.source is not distinct from q.source),
drawn as (
    select *, floor(e)::bigint as certain, case when size > 0 then e - floor(e) else 0 end as p from expected),
ranked as (
    select *, case when p > 0 then (u / (1 - u)) / (p / (1 - p)) end as q from drawn),
ordered as (
    select *, q / (1 + q) as pos, target - (sum(certain * size) over (partition by source))::double as open from ranked),
summed as (
    select *, sum(case when pos is not null then size end) over (
        partition by source order by pos nulls last, doc_id nulls first, size rows between unbounded preceding and current row) as so_far
    from ordered)
select doc_id, size, source_size, target,
    certain + coalesce(pos is not null and 2 * so_far - size <= 2 * open, false)::bigint as copies,
    (certain + coalesce(pos is not null and 2 * so_far - size <= 2 * open, false)::bigint) * size as taken
from summed
"""

# Whole texts as keys of a window.
OP12 = """
with texts as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents)
select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
    row_number() over (partition by norm order by doc_id desc nulls last) = 1 as kept, sha256(norm) as text_sha256
from texts
"""

# Every anchor scored against every row, without bounds.
OP13 = """
with vectors as (
    select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as e
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.e, b.e)::bigint as score
    from vectors a join vectors b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
    select p.anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
        row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
    from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
        and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from ranked where rank <= 3
"""

ORACLES: dict[str, str] = {
    "op1_license_scan": OP1,
    "op6_quality_rules": OP6,
    "op8_mixing": OP8,
    "op12_exact_dedup": OP12,
    "op13_hard_negatives": OP13,
}
