"""The same queries as DuckDB SQL on the same tables."""

from __future__ import annotations

from lumagrid.operators.clusters import MAX_ITER, TOLERANCE
from lumagrid.plans.registry import BINS, CENTERS, FITTED

_HDR = """
lines as (
  select label as image_id, embedding,
         row_number() over (partition by label order by vec_id) - 1 as y
  from embeddings),
hdr as (
  select image_id, y, cast(t.x as integer) as x,
         coalesce(abs(cast(embedding[3 * t.x + 1] as double)) * 10, 0) as b,
         coalesce(abs(cast(embedding[3 * t.x + 2] as double)) * 10, 0) as g,
         coalesce(abs(cast(embedding[3 * t.x + 3] as double)) * 10, 0) as r
  from lines, lateral (select unnest(range((len(embedding) + 2) // 3)) as x) t)"""

_BIG = """
items as (
  select cast(l_suppkey as integer) as image_id,
         row_number() over (partition by l_suppkey
                            order by l_orderkey, l_linenumber, l_partkey) - 1 as i,
         l_quantity / 10 as b, l_extendedprice / 10000 as g, l_tax * 100 as r
  from lineitem),
hdr as (
  select image_id, i // 25 as y, cast(i % 25 as integer) as x, b, g, r
  from items)"""

_LUM = "(b * 0.0722::double + g * 0.7152::double + r * 0.2126::double)"
_GRAY = "(b * 0.114::double + g * 0.587::double + r * 0.299::double)"

_LDR = """
ldr as (
  select image_id, y, x, cast(least(255, floor(b * 40)) as integer) as b,
         cast(least(255, floor(g * 40)) as integer) as g,
         cast(least(255, floor(r * 40)) as integer) as r
  from hdr)"""

_HOLES = """
holes as (
  select image_id, y, x, b, case when g % 7 != 0 then g end as g, r from ldr where (b + x) % 5 != 2)"""

_GRAYS = f"""
gray as (select image_id, y, x, cast(floor{_GRAY} as integer) as g from ldr)"""

_LIT = f"""
lit as (select *, {_LUM} as lum from hdr),
lit_max as (select *, max(lum) over (partition by image_id) as lum_max from lit)"""

_GAMMA = "pow(lum * pow(2::double, 0.4::double), 1 / 1.2::double)"
_LOG = "case when lum_max = 0 then 0 else log10(1 + lum) / log10(1 + lum_max) end"


def _adaptive(b: float, ld_max: float) -> str:
    return f"""case when lum_max = 0 then 0 else
      {ld_max}::double / (100 * log10(1 + lum_max)) * (ln(1 + lum) /
      ln(2 + 8 * pow(lum / lum_max, ln({b}::double) / ln(0.5::double)))) end"""


def _quantized(v: str) -> str:
    return f"cast(greatest(0, least(255, round_even({v} * 255, 0))) as integer)"


def _rescaled(source: str, new_lum: str, extra: str = "") -> str:
    channels = ", ".join(
        _quantized(f"case when lum = 0 then 0 else {c} * (new_lum / lum) end") + f" as {c}"
        for c in "bgr"
    )
    return f"select image_id, y, x, {extra}{channels} from (select *, {new_lum} as new_lum from {source})"


_EDGES = """
select a.image_id, a.y, a.x,
       cast(greatest(0, least(255, coalesce(sum(n.g * m.w), 0))) as integer) as edge
from gray a
cross join (values (-1, -1, -1), (-1, 1, 1), (0, -1, -2), (0, 1, 2), (1, -1, -1), (1, 1, 1))
  m(dy, dx, w)
left join gray n on n.image_id = a.image_id and n.y = a.y + m.dy and n.x = a.x + m.dx
group by 1, 2, 3"""

_EDGES_MIRRORED = """
select a.image_id, a.y, a.x,
       cast(greatest(0, least(255, coalesce(sum(n.g * m.w), 0))) as integer) as edge
from (select gray.*, h, w as width from gray join
      (select image_id, max(y) + 1 as h, max(x) + 1 as w from gray group by 1) using (image_id)) a
cross join (values (-1, -1, -1), (-1, 1, 1), (0, -1, -2), (0, 1, 2), (1, -1, -1), (1, 1, 1))
  m(dy, dx, w)
left join gray n on n.image_id = a.image_id
  and n.y = (h - 1) - abs((h - 1) - abs(a.y + m.dy))
  and n.x = (width - 1) - abs((width - 1) - abs(a.x + m.dx))
group by 1, 2, 3"""

_LEVELS = f"""
levels as (
  select image_id, y, x, b, g, r, round_even({_LUM} * {BINS}, 0) / {BINS} as lum from hdr),
hist as (select image_id, lum, count(*) as n_pixels from levels group by 1, 2)"""

_CENTERS = "centers as (select * from (values {}) c(cid, c))".format(
    ", ".join(f"({cid}, {c}::double)" for cid, c in enumerate(CENTERS))
)

_ASSIGNED = """
assigned as (
  select image_id, lum, n_pixels, cast(cid as integer) as cid
  from (select *, row_number() over (partition by image_id, lum
                                     order by abs(c - lum), cid) as pos
        from hist cross join centers) where pos = 1),
means as (
  select image_id, cid,
         sum(cast(n_pixels as double) * n_pixels * lum)
           / sum(cast(n_pixels as double) * n_pixels) as mean
  from assigned group by 1, 2)"""



def _fitted_centers() -> str:
    """Lloyd rounds until an image settles, over its levels as a sorted list."""
    prime = 2147483647
    inside = "list_filter(ls, lambda l: (i = 1 or l.lum > (c[i - 1] + c[i]) / 2) and (i = len(c) or l.lum <= (c[i] + c[i + 1]) / 2))"
    mass = f"list_sum(list_transform({inside}, lambda l: l.n))"
    total = f"list_sum(list_transform({inside}, lambda l: l.n * l.lum))"
    return f"""
drawn as (
  select image_id, lum, (m * m + m) % {prime} as draw
  from (select image_id, lum,
               (cast(floor(lum * 1048576) as bigint) % {prime} * 48271 + 1) % {prime} as m from hist)),
level_lists as (
  select image_id, list(struct_pack(lum := lum, n := n_pixels::double) order by lum) as ls
  from hist group by image_id),
fit as (
  select image_id, 0 as step, list_sort(list(lum order by draw, lum)[:{FITTED["k"]}]) as c, true as moving
  from drawn group by image_id
  union all
  select image_id, step + 1, moved,
         list_max(list_transform(range(1, len(c) + 1), lambda i: abs(moved[i] - c[i]))) > {TOLERANCE}
  from (select f.image_id, f.step, f.c,
               list_transform(range(1, len(c) + 1), lambda i: coalesce({total} / {mass}, c[i])) as moved
        from fit f join level_lists using (image_id) where moving and step < {MAX_ITER})),
fitted as (
  select image_id, unnest(range(len(c))) as cid, unnest(c) as c
  from (select image_id, arg_max(c, step) as c from fit group by image_id))"""


def _nearest(centers: str) -> str:
    """Levels with the number of midpoints below them."""
    return f"""
  select h.image_id, h.lum, any_value(h.n_pixels) as n_pixels, count(mid) as cid
  from hist h left join (
    select image_id, (c + lead(c) over (partition by image_id order by cid)) / 2 as mid
    from {centers}) b on b.image_id = h.image_id and b.mid < h.lum
  group by 1, 2"""


_RUNS = """
runs as (
  select event_type as section, event_id as iteration, value as serial,
         cast(user_id % 7 + 1 as double) as factor,
         value / cast(user_id % 7 + 1 as double) as variant
  from events)"""

_DISPATCH = """
dispatch as (
  select event_type as operator, value as seconds, cast(user_id % 3 as integer) as worker
  from events)"""

_ENTRIES = """
entries as (
  select vec_id as i, unnest(range(len(embedding))) as j,
         cast(unnest(embedding) as double) as v
  from embeddings)"""

_GRAM = """
gram as (
  select a.j as i, b.j as j, sum(a.v * b.v) as v
  from entries a join entries b on a.i = b.i group by 1, 2)"""


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def _with_recursive(*ctes: str) -> str:
    return "with recursive " + ",".join(ctes) + "\n"


_PRODUCT = _with(_ENTRIES, _GRAM) + "select i, j, round(v, 6) as v from gram"
_PRIME = 2147483647


def oracle_sql() -> dict[str, str]:
    hdr_levels = (_HDR, _LEVELS)
    clustered = (*hdr_levels, _CENTERS, _ASSIGNED)
    fitted = f"""select image_id, cast(cid as integer) as cid, round(c, 6) as center
                 from fitted"""
    sql = {
        "hdr_scan": _with(_HDR)
        + "select image_id, y, x, round(b, 6) as b, round(g, 6) as g, round(r, 6) as r from hdr",
        "raster_explode": """
            select vec_id as image_id, cast(p // 4 as integer) as y, cast(p % 4 as integer) as x,
                   round(cast(embedding[4 * p + 1] as double), 6) as b,
                   round(cast(embedding[4 * p + 2] as double), 6) as g,
                   round(cast(embedding[4 * p + 3] as double), 6) as r,
                   round(cast(embedding[4 * p + 4] as double), 6) as a
            from embeddings, range(len(embedding) // 4) t(p)""",
        "raster_pack": _with(_HDR, _LDR)
        + """select image_id, y as y0, cast(x - x % 16 as integer) as x0,
                    string_agg(concat(b, ',', g, ',', r), ',' order by x) as data
             from ldr group by 1, 2, 3""",
        "raster_pack_holes": _with(_HDR, _LDR, _HOLES)
        + """select image_id, y as y0, cast(min(x) as integer) as x0,
                    string_agg(concat(b, ',', coalesce(g::varchar, '-'), ',', r), ',' order by x) as data,
                    case when max(x) - min(x) + 1 > count(*)
                      then string_agg(cast(x - first_x as varchar), ',' order by x) end as offsets
             from (select *, min(x) over (partition by image_id, y, x // 16) as first_x from holes)
             group by image_id, y, x // 16""",
        "raster_round_trip": _with(_HDR, _LDR, _HOLES) + "select * from holes",
        "random_matrix": _with(_ENTRIES)
        + f"""select i, j, cast((m * m + 1) % {_PRIME} % 10 as double) as v
              from (select i, j, (m * m + m) % {_PRIME} as m
                    from (select i, j,
                                 ((i * 1000003 + j * 7919) % {_PRIME} + 42 * 48271 + 1) % {_PRIME} as m
                          from entries))""",
        "luminance": _with(_HDR) + f"select image_id, y, x, round({_LUM}, 6) as lum from hdr",
        "gray_trunc": _with(_HDR, _LDR, _GRAYS) + "select * from gray",
        "gray_round": _with(_HDR, _LDR)
        + f"select image_id, y, x, cast(round_even({_GRAY}, 0) as integer) as g from ldr",
        "gamma_per_channel": _with(_HDR)
        + "select image_id, y, x, "
        + ", ".join(_quantized(_GAMMA.replace("lum", c)) + f" as {c}" for c in "bgr")
        + " from hdr",
        "luminance_rescale": _with(_HDR, _LIT)
        + "select image_id, y, x, "
        + ", ".join(
            f"round(case when lum = 0 then 0 else {c} * (sqrt(lum) / lum) end, 6) as {c}"
            for c in "bgr"
        )
        + " from lit",
        "quantize_8bit": _with(_HDR)
        + "select image_id, y, x, "
        + ", ".join(_quantized(c) + f" as {c}" for c in "bgr")
        + " from hdr",
        "times2_wrap": _with(_HDR, _LDR, _GRAYS)
        + """select image_id, y, x, cast((2 * g) % 256 as integer) as wrapped,
                    cast(least(255, 2 * g) as integer) as saturated from gray""",
        "image_type_name": """
            select event_id, mode,
                   case mode % 8 when 0 then '8U' when 1 then '8S' when 2 then '16U' when 3 then '16S'
                     when 4 then '32S' when 5 then '32F' when 6 then '64F' else 'User' end
                     || 'C' || (1 + mode // 8) as name
            from (select event_id, cast(user_id % 32 as integer) as mode from events)""",
        "change_extension": r"""
            select name, regexp_replace(name, '\.[^.]{0,3}([^.]*)$', '.png\1') as new_name
            from (select 'test' || event_id || case user_id % 5 when 0 then '.exr' when 1 then '.jpeg'
                         when 2 then '.tar.gz' when 3 then '.h' else '' end as name
                  from events)""",
        "crop_bounds": _with(_HDR, _LDR, _GRAYS)
        + """select image_id, y - 1 as y, x - 1 as x, g from gray where y >= 1 and x >= 1""",
        "tonemap_gamma": _with(_HDR, _LIT) + _rescaled("lit", _GAMMA),
        "tonemap_log": _with(_HDR, _LIT) + _rescaled("lit_max", _LOG),
        "tonemap_log_big": _with(_BIG, _LIT) + _rescaled("lit_max", _LOG),
        "tonemap_adaptive_log": _with(_HDR, _LIT) + _rescaled("lit_max", _adaptive(0.85, 100.0)),
        "tonemap_all": _with(_HDR, _LIT)
        + " union all ".join(
            _rescaled("lit_max", curve, f"'{op}' as op, ")
            for op, curve in (
                ("gamma", _GAMMA), ("log", _LOG), ("adap_log", _adaptive(1.0, 150.0))
            )
        ),
        "sobel_zero": _with(_HDR, _LDR, _GRAYS) + _EDGES,
        "sobel_halo": _with(_HDR, _LDR, _GRAYS) + _EDGES,
        "edge_map": _with(_HDR, _LDR, _GRAYS) + _EDGES,
        "edge_map_tiles": _with(_HDR, _LDR, _GRAYS)
        + f"select image_id, y, cast(x as bigint) as x, edge from ({_EDGES})",
        "edge_map_tiles_big": _with(_BIG, _LDR, _GRAYS)
        + f"select image_id, y, cast(x as bigint) as x, edge from ({_EDGES})",
        "edge_map_big": _with(_BIG, _LDR, _GRAYS) + _EDGES,
        "sobel_reflect101": _with(_HDR, _LDR, _GRAYS) + _EDGES_MIRRORED,
        "max_luminance": _with(_HDR, _LIT)
        + "select image_id, round(max(lum), 6) as lum_max, count(*) as n_pixels from lit group by 1",
        "luminance_histogram": _with(*hdr_levels)
        + "select image_id, round(lum, 6) as lum, n_pixels from hist",
        "luminance_histogram_big": _with(_BIG, _LEVELS)
        + "select image_id, round(lum, 6) as lum, n_pixels from hist",
        "hist_lookup": _with(*hdr_levels)
        + """select l.image_id, l.y, l.x, round(l.lum, 6) as lum, h.n_pixels
             from levels l left join hist h on h.image_id = l.image_id and h.lum = l.lum""",
        "nearest_centroid": _with(*hdr_levels, _CENTERS)
        + """select image_id, y, x, cast(cid as integer) as cid
             from (select *, row_number() over (partition by image_id, y, x
                                                order by abs(c - lum), cid) as pos
                   from levels cross join centers) where pos = 1""",
        "cluster_sizes": _with(*clustered)
        + """select image_id, cid, count(*) as n_levels, cast(sum(n_pixels) as bigint) as n_pixels
             from assigned group by 1, 2""",
        "cluster_weighted_mean": _with(*clustered)
        + "select image_id, cid, round(mean, 9) as mean from means",
        "cluster_mean_lookup": _with(*clustered)
        + """select l.image_id, l.y, l.x, a.cid, round(m.mean, 9) as mean
             from levels l join assigned a on a.image_id = l.image_id and a.lum = l.lum
             join means m on m.image_id = a.image_id and m.cid = a.cid""",
        "tonemap_kmeans_fixed_centers": _with(
            *clustered,
            """
mapped as (
  select l.*, m.mean from levels l
  join assigned a on a.image_id = l.image_id and a.lum = l.lum
  join means m on m.image_id = a.image_id and m.cid = a.cid)""",
        )
        + _rescaled("mapped", "mean"),
        "kmeans_luminance": _with_recursive(*hdr_levels, _fitted_centers()) + fitted,
        "kmeans_luminance_large": _with_recursive(*hdr_levels, _fitted_centers()) + fitted,
        "tonemap_kmeans": _with_recursive(
            *hdr_levels,
            _fitted_centers(),
            f"""
assigned as ({_nearest("fitted")}),
means as (
  select image_id, cid,
         sum(cast(n_pixels as double) * n_pixels * lum)
           / sum(cast(n_pixels as double) * n_pixels) as mean
  from assigned group by 1, 2),
mapped as (
  select l.*, m.mean from levels l
  join assigned a on a.image_id = l.image_id and a.lum = l.lum
  join means m on m.image_id = a.image_id and m.cid = a.cid)""",
        )
        + _rescaled("mapped", "mean"),
        "vector_add": """select p_partkey as i, round(p_retailprice + p_size, 6) as v from part""",
        "vector_add_arrays": """
            select vec_id as i, cast(j as integer) as j,
                   round(cast(embedding[j + 1] as double)
                         + cast(embedding[len(embedding) - j] as double), 6) as v
            from embeddings, range(len(embedding)) t(j)""",
        "matmul_join": _PRODUCT,
        "matmul_tiled": _PRODUCT,
        "matmul_rows": _with(_ENTRIES, _GRAM)
        + """select e.i, g.j, round(sum(e.v * g.v), 6) as v
             from entries e join gram g on e.j = g.i group by 1, 2""",
        "matmul_rows_large": _with(_ENTRIES)
        + """select cast(label as bigint) as i, j, count(*) as n_rows, round(sum(v), 6) as v
             from (select a.i as row, b.i as j, sum(a.v * b.v) as v
                   from entries a join entries b on a.j = b.j group by 1, 2)
             join embeddings on vec_id = row group by 1, 2""",
        "results_diff": """
            with sold as (select l_partkey as i, max(l_extendedprice / l_quantity) as v
                          from lineitem group by 1),
            cells as (select p.p_retailprice as a, s.v as b
                      from part p full outer join sold s on s.i = p.p_partkey),
            counted as (
              select count(*) as n_cells,
                     count(*) filter (a is null or b is null or abs(a - b) > 0.01) as n_different,
                     count(*) filter (b is null) as n_left_only,
                     count(*) filter (a is null) as n_right_only
              from cells)
            select *, case when n_different = 0 then 'Good calculation'
                      else 'Bad calculation' end as verdict
            from counted""",
        "run_speedup": _with(_RUNS)
        + """select section, iteration, round(serial, 6) as serial, round(variant, 6) as variant,
                    round(serial / nullif(variant, 0), 6) as ratio from runs""",
        "run_bandwidth": _with(_RUNS)
        + """select section, iteration,
                    ((iteration + 1) * 3000000.0::double + (iteration + 1) * 1000000.0::double)
                      / nullif(serial, 0) / 1e9 as gb_per_s from runs""",
        "run_throughput": _with(_RUNS)
        + """select section, iteration,
                    18 * ((iteration + 1) * 1000000.0::double) / nullif(serial, 0) / 1e9
                      as gflop_per_s from runs""",
        "run_summary": _with(_RUNS)
        + "select section, count(*) as n_runs, "
        + ", ".join(
            f"round({f}({v}), 9) as {name}_{label}"
            for v, label in (
                ("serial", "serial"),
                ("variant", "variant"),
                ("serial / nullif(variant, 0)", "ratio"),
            )
            for f, name in (("avg", "mean"), ("min", "min"), ("max", "max"))
        )
        + """, round(median(serial), 9) as median_serial, round(median(variant), 9) as median_variant
             from runs group by 1""",
        "batch_report": _with(_DISPATCH)
        + """select operator, count(*) as n_files, round(sum(seconds), 6) as total_seconds
             from dispatch group by 1""",
        "worker_report": _with(_DISPATCH)
        + """select operator, worker, count(*) as n_files, round(sum(seconds), 6) as total_seconds
             from dispatch group by 1, 2""",
        "run_verdicts": _with(_RUNS)
        + """select section, count(*) filter (serial = variant * factor) as n_good,
                    count(*) filter (serial != variant * factor) as n_bad,
                    bool_and(serial = variant * factor) as all_good
             from runs group by 1""",
        "log_runs_round_trip": _with(_RUNS)
        + """select section, iteration, round(serial, 6) as serial, round(variant, 6) as variant,
                    case when serial = variant * factor then 'Good calculation'
                    else 'Bad calculation' end as verdict from runs""",
        "run_report_from_log": _with(_RUNS)
        + "select section, count(*) as n_runs, "
        + ", ".join(
            f"round({f}({v}), 9) as {name}_{label}"
            for v, label in (
                ("serial", "base"),
                ("variant", "variant"),
                ("serial / nullif(variant, 0)", "ratio"),
            )
            for f, name in (("avg", "mean"), ("min", "min"), ("max", "max"))
        )
        + """, round(median(serial / nullif(variant, 0)), 9) as median_ratio,
               count(*) filter (serial = variant * factor) as n_good,
               count(*) filter (serial != variant * factor) as n_bad,
               bool_and(serial = variant * factor) as all_good
             from runs group by 1""",
        "write_report_round_trip": """
            select 'test' || event_id || '.exr' as file, round(value, 6) as seconds,
                   cast(user_id % 3 as integer) as worker
            from events""",
    }
    sql["drain_tonemap"] = sql["tonemap_log"]
    sql["drain_report"] = _with(_HDR) + """
        select 'log' as operator, true as has_pixels, count(*) as n_pixels, cast(0 as bigint) as n_empty,
               true as each_once from hdr
        union all select 'log', false, 0, 3, true"""
    sql["image_files_round_trip"] = _with(_HDR, _LDR) + """
        select image_id || '.png' as image_id, cast(y as integer) as y, x, b, g, r from ldr"""
    sql["image_headers"] = _with(_HDR) + """
        select image_id || '.png' as name, cast(max(x) + 1 as integer) as width,
               cast(max(y) + 1 as integer) as height, 3 as n_channels, 16 as mode
        from hdr group by image_id"""
    sql["list_images"] = """
        select cast(n_regionkey as bigint) as n_regionkey,
               case n_nationkey % 5 when 1 then '.' when 2 then '_' else '' end
                 || replace(n_name, ' ', '+') || '.txt' as name,
               case when n_nationkey % 4 != 0 then strlen(n_name) else 0 end as length
        from nation"""
    sql["unreadable_images"] = """
        select n_nationkey || '.exr' as name,
               case when n_nationkey % 4 != 0 then strlen(n_name) else 0 end as length
        from nation"""
    sql["replace_extension"] = """
        select name, replace(name, '.exr', '.png') as new_name
        from (select 'test' || event_id || case user_id % 4 when 0 then '.exr' when 1 then '.exr.exr'
                     when 2 then '.exr.png' else '.jpg' end as name from events)"""
    sql["log_batches_round_trip"] = """
        select event_type as section, 0 as worker, count(distinct event_id // 4096) as n_batches,
               round(sum(round(value, 6)), 4) as seconds
        from events group by 1"""
    sql["log_summaries_round_trip"] = """
        select event_type as section, count(distinct event_id // 4096) as n_summaries,
               max(round(value, 6)) as largest, cast(0 as bigint) as n_workers
        from events group by 1"""
    sql["views_sql"] = _with(
        _HDR,
        _LDR,
        _GRAYS,
        _LIT,
        f"edges as ({_EDGES})",
        f"gammas as ({_rescaled('lit', _GAMMA)})",
        f"logs as ({_rescaled('lit_max', _LOG)})",
    ) + f"""
        select image_id, count(*) as n_pixels, round(max(lum_max), 6) as lum_max,
               sum(gammas.b)::bigint as gamma_b, sum(logs.g)::bigint as log_g,
               sum({_quantized("lit_max.r")})::bigint as quantized_r,
               sum(edge)::bigint as edges, sum((2 * gray.g) % 256)::bigint as doubled,
               (select count(*) from events where user_id % 32 % 8 = 0) as n_files
        from lit_max join gammas using (image_id, y, x) join logs using (image_id, y, x)
        join edges using (image_id, y, x) join gray using (image_id, y, x)
        group by image_id"""
    sql["write_ldr_round_trip"] = sql["tonemap_gamma"]
    return sql
