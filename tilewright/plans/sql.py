"""DuckDB SQL for the registered queries, written from their definitions and independent of the operators' code."""

from __future__ import annotations

from tilewright.functions.seq import STANDARD_CODE
from tilewright.operators import identify
from tilewright.plans.queries import P, SEED

L, K = P.length, P.contiguity
LOW, HIGH = P.gc_bounds
DNA = """dna as (
    select doc_id as id, lang as node_id, source as org, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as seq
    from documents where regexp_matches(text, '[A-Za-z]')
)"""
ITEMS = DNA.replace("dna as", "items as").replace("doc_id as id, lang as node_id, source as org", "item_id as id").replace("documents", "benchmark")


def rc(x: str) -> str:
    return f"reverse(translate({x}, 'ACGT', 'TGCA'))"


def pack(x: str) -> str:
    return f"list_reduce(list_transform(string_split({x}, ''), lambda c: (instr('ACGT', c) - 1)::bigint), lambda a, b: a * 4 + b)"


def windows(name: str, of: str, n: int, cols: str = "id") -> str:
    return f"{name} as (select {cols}, pos, substr(seq, pos, {n}) as w from (select {cols}, seq, unnest(range(1, length(seq) - {n - 2}))::int as pos from {of} where length(seq) >= {n}))"


GC = f"gcw as (select id, pos, length(replace(replace(w, 'A', ''), 'T', ''))::int as gc from win), ok as (select * from gcw where gc >= {LOW} and gc < {HIGH})"
RUNS = f"runs as (select id, min(pos)::int as pos, (max(pos) - min(pos) + {L})::int as len, count(*) as n from (select id, pos, pos - row_number() over (partition by id order by pos) as island from ok) group by id, island)"
REGIONS = f"""with {DNA}, {windows('win', 'dna', L)}, {GC}, {RUNS}, cutout as (
    select r.id, org, pos, len, substr(seq, pos, len) as seq, md5(substr(seq, pos, len)) as region_id from runs r join dna using (id)
), regions as (select region_id, id as cluster_id, pos, len, seq from (select *, row_number() over (partition by region_id order by id, pos) as k from cutout) where k = 1),
region_org as (select distinct region_id, coalesce(org, '') as org from cutout)"""


def spacing(d: str) -> str:
    return f"(case when {d} <= 1 then {L} when len < {2 * L} then greatest(1, floor((len - {L}) / ({d} - 1))) else greatest(1, floor({L - 1} / ({d} - 1))) end)::bigint"


def baits(d: str) -> str:
    return f"ceil((len - {L} + 1) / {spacing(d)})::bigint"


HI = f"(case when len >= {2 * L - 1} then {L} else len - {L} + 1 end)::int"
BOUNDS = f"bounds as (select *, {HI} as hi, least({HI}, {P.density})::int as lo from regions), tiled as (select *, {baits('lo')} as n_lo, {baits('hi')} as n_hi from bounds)"

TM = f"""
tmtab(pair, h, s) as (values {', '.join(f"('{k}', {h}, {s})" for k, (h, s) in identify.neighbour_table().items())}),
base as (select id, org, i, substr(seq, i, 1) as b, substr(seq, i, 2) as pair from (select id, org, seq, unnest(range(1, length(seq) + 1))::int as i from dna where length(seq) >= {L})),
summed as (
    select id, org, i, b, lead(b, {L - 1}) over w as last_b, lead(i, {L - 1}) over w as last_i,
           sum(h) over (partition by id order by i rows between current row and {L - 2} following) as h, sum(s) over (partition by id order by i rows between current row and {L - 2} following) as s
    from base left join tmtab using (pair) window w as (partition by id order by i)
),
tms as (
    select id, org, i as pos, 1000 * (h + e1 + e2) / (s + f1 + f2 + {identify.GAS} * ln({identify.CONCENTRATION} / 4)) + 12 * log10({identify.SALT}) - 273.15 as tm
    from (select *, case when b in ('A', 'T') then {identify.END_AT[0]} else {identify.END_GC[0]} end as e1, case when last_b in ('A', 'T') then {identify.END_AT[0]} else {identify.END_GC[0]} end as e2,
                 case when b in ('A', 'T') then {identify.END_AT[1]} else {identify.END_GC[1]} end as f1, case when last_b in ('A', 'T') then {identify.END_AT[1]} else {identify.END_GC[1]} end as f2
          from summed where last_i is not null)
)"""

UNIQUE = f"""{windows('kw', 'dna', K, 'id, node_id')}, km as (select id, node_id, pos, least(w, {rc('w')}) as kmer from kw),
shared as (select kmer from km group by kmer having count(distinct node_id) > 1), bad as (select id, pos from km where kmer in (select kmer from shared)),
starts as (select id, node_id, unnest(range(1, length(seq) - {L - 2}))::int as p from dna where length(seq) >= {L}),
good as (select s.id, s.node_id, s.p from starts s asof left join (select id, pos from bad) b on s.id = b.id and s.p + {L - K} >= b.pos where b.pos is null or b.pos < s.p),
uniq as (select id, node_id, min(p)::int as s, (max(p) + 1)::int as e from (select *, p - row_number() over (partition by id order by p) as island from good) group by id, node_id, island)"""

SPANS = "spans as (select user_id, event_type, (epoch_us(ts) // 1000) as s, (epoch_us(ts) // 1000) + floor(abs(value) * 60000)::bigint + 1 as e from events)"


def merged(keys: str) -> str:
    return f"""merged as (select {keys}, min(s) as s, max(e) as e from (
        select *, sum(fresh) over (partition by {keys} order by s, e rows unbounded preceding) as island from (
            select *, case when max(e) over (partition by {keys} order by s, e rows between unbounded preceding and 1 preceding) >= s then 0 else 1 end as fresh from spans)
    ) group by {keys}, island)"""


TURNS = "turns as (select *, case when lag(o_orderstatus) over w = o_orderstatus then 0 else 1 end as t from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)), numbered as (select *, sum(t) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding)::bigint as run from turns), rle as (select o_custkey, run, any_value(o_orderstatus) as o_orderstatus, count(*) as n from numbered group by 1, 2)"

FAMILIES = f"{DNA}, fam as (select length(seq)::varchar as family, id::varchar as uid, seq as aligned from dna), cols as (select family, uid, i, substr(aligned, i, 1) as b from (select *, unnest(range(1, length(aligned) + 1))::int as i from fam)), votes as (select family, i, b, count(*) as n from cols group by all), winners as (select family, i, first(b order by n desc, b) as b from votes group by all), cons as (select family, string_agg(b, '' order by i) as seq from winners group by family)"
CIGARS = f"{FAMILIES}, ops as (select c.family, uid, c.i, case when c.b = w.b then '=' else 'X' end as op from cols c join winners w on c.family = w.family and c.i = w.i), marks as (select *, i - row_number() over (partition by family, uid, op order by i) as island from ops), pieces as (select family, uid, op, min(i) as head, count(*) as n from marks group by family, uid, op, island), cigars as (select family, uid, string_agg(n || op, '' order by head) as cigar from pieces group by all)"

NODES = "nodes as (select 'N:' || n_name as node_id, 'R:' || r_name as parent_id, true as is_leaf from nation join region on n_regionkey = r_regionkey union all select 'R:' || r_name, 'WORLD', false from region union all select 'WORLD', null, false), up(ancestor, node_id, distance) as (select node_id, node_id, 0 from nodes union all select n.parent_id, up.node_id, up.distance + 1 from up join nodes n on n.node_id = up.ancestor where n.parent_id is not null)"
MEMBERS = "members as (select distinct l_partkey as cluster_id, 'N:' || n_name as taxon_id, r_name from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"
LCA = f"""{NODES}, {MEMBERS}, leaves as (select ancestor, count(*) as leaves from up join nodes using (node_id) where is_leaf group by 1), depth as (select node_id as ancestor, max(distance) as depth from up group by 1),
sizes as (select cluster_id, count(*) as size from members group by 1), above as (select cluster_id, ancestor, count(*) as n from members join up on taxon_id = node_id group by 1, 2),
lca as (select cluster_id, arg_max(ancestor, depth) as node_id, any_value(size) as size from above join sizes using (cluster_id) join depth using (ancestor) where n = size group by 1),
assigned as (select cluster_id, node_id, round(100.0 * size / leaves, 6)::double as penetrance from lca join leaves on ancestor = node_id)"""
MASKS = f"{MEMBERS}, idx as (select r_name, row_number() over (order by r_name) - 1 as i, count(*) over () as n from region), masks as (select cluster_id, bit_or(1::bigint << i::int) as mask, any_value(n) as n from (select distinct cluster_id, r_name from members) join idx using (r_name) group by 1)"
SPLITS = f"{MASKS}, splits as (select case when 2 * bit_count(mask) > n or (2 * bit_count(mask) = n and (mask >> (n - 1)::int) & 1 = 1) then xor(mask, (1::bigint << n::int) - 1) else mask end as mask from masks), counted as (select mask, count(*)::double as count, bit_count(mask)::int as size from splits where mask <> 0 group by 1)"

SEEDS = f"""{DNA}, {ITEMS}, strands as (select id, '+' as strand, seq from items union all select id, '-', {rc('seq')} from items), {windows('aw', 'dna', SEED)}, {windows('bw', 'strands', SEED, 'id, strand')},
hits as (select aw.id as a_id, bw.id as b_id, strand, (aw.pos - bw.pos)::int as diagonal, count(*) as seeds from aw join bw using (w) group by all)"""
ITEM_KMERS = f"{DNA}, {ITEMS}, {windows('iw', 'items', K)}, {windows('dw', 'dna', K)}, pruned as (select id, count(*) as kmers from dw where w in (select w from iw) group by 1)"


ROUNDS = 12
TOTALS = f"""{REGIONS}, {BOUNDS}, totals as materialized (select org, sum(n_lo)::hugeint as n_lo, sum(n_hi)::hugeint as n_hi, count(*) as regions from region_org join tiled using (region_id) group by 1),
ends as materialized (select region_id, any_value(t.n_lo)::hugeint as n_lo, any_value(t.n_hi)::hugeint as n_hi, min(o.n_hi) as low, max(o.n_lo) as high from region_org join tiled t using (region_id) join totals o using (org) group by 1), wanted as (select (sum(n_hi) // 2)::hugeint as budget from tiled)"""


def _classes() -> str:
    """Rounds of ideal = med / n, unrolled: classes are found anew by each ideal, a region counts once and Max before Min; a round that settles is carried on."""
    out = f"{TOTALS}, s0 as (select (select budget from wanted) as med, count(*)::hugeint as n, []::double[] as seen, false as stop from totals)"
    for k in range(ROUNDS):
        out += f""", t{k} as (select *, med::double / n as ideal, (select budget from wanted) - coalesce((select sum(case when low * n < med then n_hi when high * n > med then n_lo end) from ends), 0) as med2,
            (select count(*) from totals where n_hi * n >= med and n_lo * n <= med)::hugeint as n2 from s{k}),
        s{k + 1} as (select case when halt then med else med2 end as med, case when halt then n else n2 end as n, list_append(seen, ideal) as seen, halt as stop
            from (select *, stop or n2 = 0 or n2 = (select count(*) from totals) or list_contains(seen, ideal) as halt from t{k}))"""
    return f"{out}, classes as materialized (select org, regions, case when n_hi * n < med then 'Max' when n_lo * n > med then 'Min' else 'Med' end as class from totals, s{ROUNDS})"


def _dense() -> str:
    """Regions one by one, in the order of turns: lacks and gives hold every organism's numbers, times the number of Med organisms."""
    pick = "list_reduce(list_transform(orgs, lambda o: {'d': greatest(lacks[o], 0), 's': greatest(lacks[o], 0) + gives[o]}), lambda a, b: case when b.d * a.s > a.d * b.s then b else a end)"
    dense = f"case when a + b = b * (-((-len - 1) // {L})) then 1 when len < {2 * L} then (a * (len - {L})) // (b * (len - {L} + 1)) + 1 else (a * {L - 1}) // (b * (len - {L} + 1)) + 1 end::int"
    own = "list_transform(range(1, len(lacks) + 1), lambda o: case when list_contains(orgs, o) then {0}[o] - {1} * n else {0}[o] end)"
    return f"""{_classes().replace('with dna', 'with recursive dna', 1)}, numbered as (select *, row_number() over (order by regions, org) as turn from classes),
    shared as (select *, count(*) over (partition by region_id) as n_org from region_org), ranked as (select org, region_id, row_number() over (partition by org order by n_org, len, region_id) as k from shared join regions using (region_id)),
    seen as (select region_id, bool_or(class = 'Max') as most, min((turn, -k)) filter (class = 'Med') as place, list(turn order by turn) as orgs from ranked join numbered using (org) group by 1),
    fixed as materialized (select region_id, case when most then hi else lo end as density, case when most then n_hi else n_lo end as probes from seen join tiled using (region_id) where most or place is null),
    opened as materialized (select region_id, len, n_lo::hugeint as n_lo, n_hi::hugeint as n_hi, orgs, row_number() over (order by place) as i from seen join tiled using (region_id) where not most and place is not null),
    med as materialized (select (select budget from wanted) - coalesce((select sum(probes) from fixed), 0) as rest, (select count(*) from classes where class = 'Med')::hugeint as n),
    had as (select turn, rest - n * coalesce((select sum(probes) from region_org join fixed using (region_id) where org = numbered.org), 0) as lack,
        n * coalesce((select sum(n_hi) from region_org join opened using (region_id) where org = numbered.org), 0) as give from numbered, med),
    run(i, lacks, gives, region_id, density) as (
        select 0::bigint, (select list(lack::hugeint order by turn) from had), (select list(give::hugeint order by turn) from had), null::varchar, null::int
        union all
        select i, {own.format('lacks', 'probes')}, {own.format('gives', 'n_hi')}, region_id, density from (select *, {baits('density')}::hugeint as probes from (select *, {dense} as density from (
            select *, (best.s - best.d) * n_lo + best.d * n_hi as a, best.s as b from (select o.*, lacks, gives, n, {pick} as best from run join opened o on o.i = run.i + 1, med))))
    ), chosen as (select region_id, density::int as density from fixed union all select region_id, density from run where i > 0),
    proportional as (select t.*, density, {baits('density')} as probes from tiled t join chosen using (region_id))"""


def oracle_sql() -> dict[str, str]:
    win = f"with {DNA}, {windows('win', 'dna', L)}, {GC}"
    return {
        "seq_revcomp": f"with {DNA} select id, {rc('seq')} as rc from dna",
        "seq_gc": f"with {DNA} select id, length(seq)::int as n, length(replace(replace(seq, 'A', ''), 'T', ''))::int as gc from dna",
        "seq_kmers": f"with {DNA}, {windows('kw', 'dna', K)}, c as (select least(w, {rc('w')}) as k, count(*) as n from kw group by 1 having count(*) > 1) select {pack('k')} as kmer, n from c",
        "seq_pack2bit": f"with {DNA}, cut as (select id, k::int as k, substr(seq, k * 31 + 1, 31) as piece from (select id, seq, unnest(range(0, (length(seq) + 30) // 31)) as k from dna)) select id, k as \"at\", {pack('piece')} as packed from cut",
        "codon_translation": f"with {DNA} select id, array_to_string(list_transform(range(0, length(seq) // 3), lambda i: substr('{STANDARD_CODE}', (16 * (instr('TCAG', substr(seq, 3 * i + 1, 1)) - 1) + 4 * (instr('TCAG', substr(seq, 3 * i + 2, 1)) - 1) + instr('TCAG', substr(seq, 3 * i + 3, 1)))::int, 1)), '') as protein from dna",
        "windows_gc_filter": f"{win} select id, count(*) as windows, min(gc) as least, max(gc) as most from ok group by 1",
        "collapse_runs": f"{win}, {RUNS} select * from runs",
        "collapse_window_rows": f"{win}, {RUNS} select * from runs",
        "melting_temp": f"with {DNA}, {TM} select id, count(*) as windows, round(min(tm), 6) as least, round(max(tm), 6) as most from tms group by 1",
        "tm_best_interval": f"""with {DNA}, {TM}, bins as (select distinct coalesce(org, '') as org, floor(tm * 100)::bigint as bin from tms), range_ as (select min(bin) - {round(P.tm_range * 100) - 1} as a, max(bin) as b from bins),
            cand as (select unnest(range(a, b + 1)) as low from range_), covered as (select low, count(distinct org) as nodes from cand join bins on bin >= low and bin < low + {round(P.tm_range * 100)} group by 1)
            select low / 100 as low, (low + {round(P.tm_range * 100)}) / 100 as high, nodes from covered order by nodes desc, low desc limit 1""",
        "kmer_unique_windows": f"with {DNA}, {UNIQUE} select id, s, e from uniq",
        "pseudo_genomes": f"with {DNA}, placed as (select node_id, id as cluster_id, (row_number() over w)::int as ord, coalesce(sum(length(seq) + 1) over (partition by node_id order by id rows between unbounded preceding and 1 preceding), 0)::bigint as start, sum(length(seq) + 1) over (partition by node_id) as total from dna window w as (partition by node_id order by id)) select node_id, cluster_id, ord, start from placed where total >= {L + P.flank}",
        "segment_offsets": f"with {DNA} select org, id, (row_number() over (partition by org order by id))::int as ord, coalesce(sum(length(seq) + 1) over (partition by org order by id rows between unbounded preceding and 1 preceding), 0)::bigint as start from dna",
        "pos_to_segment": f"""with {DNA}, segs as (select org, id, length(seq) as len, coalesce(sum(length(seq) + 1) over (partition by org order by id rows between unbounded preceding and 1 preceding), 0)::bigint as start from dna),
            points as (select org, unnest(range(0, total)) as pos from (select org, max(start + len)::bigint as total from segs group by 1))
            select p.org, p.pos, case when p.pos - start < len then id else -1 end as segment, case when p.pos - start < len then p.pos - start else -1 end as local from points p asof join segs s on p.org = s.org and p.pos >= s.start""",
        "middle_windows": f"with {DNA}, {UNIQUE} select node_id, id, floor((s + e - 1) / 2)::int as pos from (select *, row_number() over (partition by node_id order by e - s desc, id, s) as k from uniq) where k <= 25",
        "interval_merge": f"with {SPANS}, {merged('user_id')} select * from merged",
        "region_overlap_merge": f"with {SPANS}, {merged('user_id, event_type')} select * from merged",
        "interval_subtract": f"with {SPANS}, {merged('user_id')}, gaps as (select user_id, e as s, lead(s) over (partition by user_id order by s) as e from merged) select user_id, s, e, (row_number() over (partition by user_id order by s) - 1)::int as piece from gaps where e > s",
        "rle_encode": f"with {TURNS} select * from rle",
        "longest_run": f"with {TURNS} select o_custkey, o_orderstatus, n, run from (select *, row_number() over (partition by o_custkey order by n desc, run) as k from rle) where k = 1",
        "keep_first_dedupe": "select user_id, event_type, event_id, ms from (select *, (epoch_us(ts) // 1000) as ms, row_number() over (partition by user_id, event_type order by (epoch_us(ts) // 1000), event_id) as k from events) where k = 1",
        "singletons": "select any_value(p_brand || ' ' || p_type || ' ' || p_size) || '_00000' as cluster_id, any_value(p_partkey)::varchar as uid, any_value(p_name) as seq, length(any_value(p_name)) || '=' as cigar from part group by p_brand || ' ' || p_type || ' ' || p_size having count(*) = 1",
        "consensus": f"with {FAMILIES} select * from cons",
        "pairwise_distance": f"with {FAMILIES} select x.family, x.uid as a, y.uid as b, round(1 - count(*) filter (x.b = y.b) / count(*)::double, 9) as d from cols x join cols y on x.family = y.family and x.i = y.i and x.uid < y.uid group by 1, 2, 3",
        "cigar_build": f"with {CIGARS} select * from cigars",
        "cigar_simplify": f"with {CIGARS} select uid, family || 'M' as cigar from cigars",
        "cigar_adjust": f"with {CIGARS}, asked as (select uid, family::int as n, unnest(range(1, family::int + 12, 11))::int as pos from cigars) select uid, pos, case when pos <= n then pos else -1 end as on_seq from asked",
        "tree_closure": f"with recursive {NODES} select ancestor, node_id, distance::int as distance from up",
        "lca_penetrance": f"with recursive {LCA} select * from assigned",
        "penetrance_relabel": f"with recursive {LCA} select cluster_id, case when penetrance < {P.penetrance} then '_LOWPEN_' else node_id end as node_id, penetrance from assigned",
        "bipartition_counts": f"with {SPLITS} select * from counted",
        "bip_compatible": f"with {SPLITS} select x.mask as a, y.mask as b, (x.mask & y.mask = 0 or x.mask & y.mask = x.mask or x.mask & y.mask = y.mask) as fits from counted x join counted y on x.mask < y.mask",
        "outgroup_taxa": f"with {MASKS}, seen as (select r_name as taxon_id, count(mask) as n from idx left join masks on bit_count(mask) >= 2 and (mask >> i::int) & 1 = 1 group by 1) select taxon_id, n from seen where n = (select min(n) from seen)",
        "seed_hits": f"with {SEEDS} select * from hits",
        "identity_reject": f"""with {SEEDS}, cut as (select h.a_id, h.b_id, h.strand, h.diagonal, greatest(1, h.diagonal + 1) as start, d.seq as x, b.seq as y from hits h join dna d on d.id = h.a_id join strands b on b.id = h.b_id and b.strand = h.strand),
            same as (select a_id, b_id, strand, diagonal, i, (substr(x, i::int, 1) = substr(y, (i - diagonal)::int, 1))::int as eq from (select *, unnest(range(start, least(length(x), length(y) + diagonal) + 1)) as i from cut)),
            slid as (select *, sum(eq) over w as total, count(*) over w as n from same window w as (partition by a_id, b_id, strand, diagonal order by i rows between current row and {L - 1} following))
            select a_id, b_id, strand, diagonal, max(total)::int as best, arg_max(i, (total, -i))::int as "at" from slid where n = {L} group by all having max(total) > {P.max_identity}""",
        "semi_pruned_clusters": f"with {ITEM_KMERS} select * from pruned",
        "anti_blacklist": f"with {ITEM_KMERS} select id, length(seq)::int as n from dna where id not in (select id from pruned)",
        "hairpins": f"with {DNA}, tried as (select id, seq, loop, unnest(range(1, length(seq) - 10 - loop))::int as p from dna, (select unnest([1, 2, 3]) as loop) where length(seq) >= 12 + loop) select id, loop::int as loop, count(*) as n from tried where substr(seq, p, 6) = {rc('substr(seq, p + 6 + loop, 6)')} group by 1, 2",
        "gff_genes": f"""with {DNA}, g as (select * from dna where length(seq) >= 90)
            select id::varchar as taxon_id, 'c1' as chr, 'fam' || (length(seq) % 7) as family, 'g' || id || 'a.' || id || '.1' as uid, 'g' || id || 'a' as gene_id, 1 as start, 60 as "end", '+' as strand, substr(seq, 1, 60) as seq from g
            union all select id::varchar, 'c1', 'UNKNOWN', 'g' || id || 'b.' || id || '.2', 'g' || id || 'b', 31, 90, '-', {rc('substr(seq, 31, 60)')} from g""",
        "fasta_files": f"with {DNA} select id::varchar as cluster_id, seq from dna where node_id = 'en'",
        "cluster_info_files": f"with {CIGARS} select c.family as ClusterID, node_id as TaxonID, '1' as SeqID, uid as GeneID, 1 as Start, length(seq)::int as \"End\", '+' as Strand, cigar as CIGAR from cigars c join dna on uid = id::varchar where length(seq) % 2 = 0",
        "assignment_files": f"with recursive {LCA}, short as (select cluster_id, node_id, round(penetrance, 2) as penetrance from assigned) select cluster_id, case when penetrance < {P.penetrance} then '_LOWPEN_' else node_id end as node_id, penetrance from short",
        "newick_files": f"with recursive {NODES} select node_id, parent_id, is_leaf from nodes",
        "region_files": f"with {DNA}, {windows('win', 'dna', L)}, {GC}, {RUNS}, placed as (select node_id, lpad(id::varchar, 12, '0') as cluster_id, pos, len, substr(seq, pos, len) as seq from runs join dna using (id) where len >= {2 * L}) select 'FBR_' || printf('%06d', row_number() over (order by node_id, cluster_id, pos) - 1) as region_id, * from placed",
        "probe_files": f"{REGIONS}, one as (select *, {baits('1')} as n, {spacing('1')} as step from regions), placed as (select *, floor((len - {L} - (n - 1) * step) / 2)::bigint as begin from one), offs as (select *, begin + step * unnest(range(0, n)) as o from placed), each as (select o.region_id, c.node_id, o.cluster_id, o.pos + o as clust_pos, substr(o.seq, (o + 1)::int, {L}) as seq from offs o join dna c on c.id = o.cluster_id) select 'Probe_' || printf('%06d', row_number() over (order by region_id, clust_pos) - 1) as ProbeID, node_id as TaxonID, cluster_id::varchar as ClustID, clust_pos::int as ClustPos, seq from each",
        "interval_files": f"with spans as (select 'u' || user_id as region_id, (event_id % 100 + 1)::int as s, (event_id % 100 + 11)::int as e from events union all select 'u' || user_id, least(event_id % 50 + 30, event_id % 70 + 1)::int, (greatest(event_id % 50 + 30, event_id % 70 + 1) + 1)::int from events where event_id % 40 >= {P.hit_length} and event_id % 101 >= {P.hit_identity}), {merged('region_id')} select * from merged",
        "acgt_segments": r"""with letters as (select doc_id as id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) as s from documents),
            chars as (select id, unnest(string_split(s, '')) as c, unnest(range(len(s))) as i from letters where len(s) > 0),
            marked as (select *, i - row_number() over (partition by id order by i) as island from chars where c in ('A', 'C', 'G', 'T'))
            select id, min(i)::bigint as "offset", string_agg(c, '' order by i) as seq from marked group by id, island""",
        "nearest_gap": """with letters as (select doc_id as id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) as s from documents),
            marks as (select id, i from (select id, unnest(string_split(s, '')) as c, unnest(range(len(s))) as i from letters where len(s) > 0) where c = 'N'),
            points as (select id, unnest(range(0, len(s))) as pos from letters where len(s) > 0)
            select p.id, p.pos, coalesce(p.pos - a.i, -1) as before, coalesce(b.i - p.pos, -1) as after from points p asof left join marks a on p.id = a.id and p.pos >= a.i asof left join marks b on p.id = b.id and p.pos <= b.i""",
        "leaf_expansion": f"with recursive {LCA}, placed as (select cluster_id as region_id, case when cluster_id % 11 = 0 then 'nowhere' else node_id end as node_id from assigned), leaf as (select ancestor, u.node_id as leaf from up u join nodes n on n.node_id = u.node_id where is_leaf) select region_id, coalesce(leaf, node_id) as org from placed left join leaf on ancestor = node_id",
        "stage_counts": f"{REGIONS}, j as (select * from region_org join regions using (region_id)) select stage, count(*) as regions, count(distinct org) as taxa from j, (values ('all', 0), ('long', {2 * L}), ('longer', {10 * L})) t(stage, least) where len >= least group by stage",
        "organism_summary": f"{REGIONS}, {BOUNDS} select org, sum(n_lo)::bigint as probes, 'Min' as class from region_org join tiled using (region_id) group by 1",
        "tiling_class": f"{_classes()} select org, class from classes",
        "proportional_tiling": f"{_dense()} select region_id, len, lo, hi, density, probes from proportional",
        "tiling_bounds": f"{REGIONS}, {BOUNDS} select region_id, len, lo, hi, n_lo, n_hi from tiled",
        "bait_counts": f"{REGIONS}, {BOUNDS} select org, sum(n_lo)::bigint as n_lo, sum(n_hi)::bigint as n_hi, count(*) as regions from region_org join tiled using (region_id) group by 1",
        "constant_tiling": f"{REGIONS}, budget as (select sum({baits('4')}) as most from regions), each as (select len, least(d, {HI}) as own, d from regions, range(1, {L + 1}) t(d)), totals as (select d, sum({baits('own')})::bigint as probes from each group by d) select d::int as density, probes from totals where probes <= (select most from budget) order by d desc limit 1",
        "priority_order": f"{REGIONS}, shared as (select *, count(*) over (partition by region_id) as n_org from region_org) select org, region_id, n_org, len, (row_number() over (partition by org order by n_org, len, region_id))::int as priority from shared join regions using (region_id)",
        "probe_emission": f"{REGIONS}, {BOUNDS}, steps as (select *, {spacing('lo')} as step, n_lo as n from tiled), placed as (select *, floor((len - {L} - (n - 1) * step) / 2)::bigint as begin from steps), offs as (select *, begin + step * unnest(range(0, n)) as o from placed) select cluster_id, pos + o as clust_pos, substr(seq, (o + 1)::int, {L}) as seq from offs",
    }
