"""Queries over the fixtures, by name, with DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SMALL
from ..functions import scalars as fn
from ..operators import budget, change, evaluate, publish, seeds, select, vectors
from ..sources import boundaries
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Data:
    """The fixtures and what follows from them, made when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        made = {
            "frames": lambda: fx.frames(self.spark, self.dir), "videos": lambda: fx.videos(self.spark, self.dir), "shots": lambda: fx.shots(self.spark, self.dir),
            "metrics": lambda: fx.metrics(self.spark, self.dir), "vectors": lambda: fx.vectors(self.spark, self.dir), "grids": lambda: fx.grids(self.spark, self.dir),
            "zones": lambda: boundaries.zones(self.shots, self.videos), "seeds": lambda: seeds.seeds(self.shots, SMALL),
            "known": lambda: self.seeds.join(self.metrics, change.FRAME), "enriched": lambda: change.enriched(self.seeds, self.metrics, SMALL),
            "plan": lambda: (lambda c: budget.plan(c, budget.half_of_extras(c)))(budget.capacities(self.seeds)),
            "admitted": lambda: budget.admitted(self.enriched, self.plan), "candidates": lambda: self.enriched.join(self.vectors, change.FRAME),
            "twins": lambda: vectors.semantic_duplicates(self.candidates, SMALL),
            "views": lambda: select.select_views(self.enriched, self.shots, self.videos, self.twins, SMALL),
        }.get(name)
        if made is None:
            raise AttributeError(name)
        value = made()
        if name in ("enriched", "twins"):  # read several times
            value = fx.written(value)
        setattr(self, name, value)
        return value


def query(sql: str | None = None):
    """Register a function of ``Data``; ``sql`` may use the views in ``VIEWS`` by name."""

    def keep(function: Callable[[Data], DataFrame]):
        QUERIES[function.__name__] = lambda spark, sf_dir: function(Data(spark, sf_dir))
        if sql:
            SQL[function.__name__] = _with_views(sql)
        return function

    return keep


#: Views in DuckDB SQL, each on those before it.
VIEWS = {
    "fx_frames": """select concat('U', lpad(cast(user_id as varchar), 6, '0')) as video_id, event_id, event_type, value,
        row_number() over (partition by user_id order by ts, event_id) - 1 as frame_idx,
        case when lag(ts) over (partition by user_id order by ts, event_id) is null or ts - lag(ts) over (partition by user_id order by ts, event_id) > interval '24' hour then 1 else 0 end as brk
        from events""",
    "fx_marked": "select *, cast(sum(brk) over (partition by video_id order by frame_idx) as bigint) as shot_id, brk = 1 and event_type = 'error' as in_zone from fx_frames",
    "fx_videos": "select video_id, max(frame_idx) + 1 as frame_count, 25.0::double as fps from fx_frames group by video_id",
    "fx_shots": "select video_id, shot_id, min(frame_idx) as start_frame, max(frame_idx) as end_frame from fx_marked where not in_zone group by video_id, shot_id",
    "fx_metrics": """select video_id, shot_id, frame_idx, event_id, event_id % 8 as dhash, cast((event_id * 17) % 64 as double) as luma_std, cast(event_id % 101 as double) / 101 as text_proxy,
        value < 15 as hard_invalid, case when value < 15 then 0e0 else least(1e0, value / 500) end as quality_score from fx_marked where not in_zone and event_id % 97 <> 0""",
    "fx_vectors": "select m.video_id, m.shot_id, m.frame_idx, list_transform(e.embedding, lambda x: x::double) as v from fx_metrics m join embeddings e on e.vec_id = m.event_id % case when m.event_id % 3 = 0 then (select count(*) from embeddings) else 7 end",
    "fx_grids": "select vec_id, list_transform(embedding, lambda x: least(255e0, greatest(0e0, (x::double + 0.6e0) * 200e0))) as g from embeddings",
    "zones": """select video_id, coalesce(before, -1) + 1 as start_frame, start_frame - 1 as end_frame, 'unassigned_gap' as kind
        from (select *, lag(end_frame) over (partition by video_id order by start_frame) as before from fx_shots) where start_frame > coalesce(before, -1) + 1
        union all select s.video_id, max(end_frame) + 1, max(frame_count) - 1, 'unassigned_tail' from fx_shots s join fx_videos using (video_id) group by s.video_id having max(end_frame) < max(frame_count) - 1""",
    "parts": """select video_id, shot_id, unnest(case when end_frame - start_frame + 1 < 4 then [(start_frame + end_frame) // 2] else generate_series(start_frame + 3, end_frame, 4) end) as frame_idx, 'periodic' as reason, true as locator from fx_shots
        union all select video_id, shot_id, start_frame, 'boundary_start', false from fx_shots union all select video_id, shot_id, end_frame, 'boundary_end', false from fx_shots
        union all select video_id, shot_id, (start_frame + end_frame) // 2, 'short_shot', false from fx_shots where end_frame - start_frame + 1 <= 4
        union all select video_id, shot_id, start_frame + cast(round_even((end_frame - start_frame) * f, 0) as bigint), name, false
        from fx_shots, (values (0.25::double, 'stable_q1'), (0.5::double, 'stable_mid'), (0.75::double, 'stable_q3')) t(f, name) where end_frame - start_frame + 1 > 4""",
    "seeds": "select video_id, shot_id, frame_idx, list_sort(list_distinct(list(reason))) as reasons, bool_or(locator) as locator from parts group by all",
    "known": "select s.*, m.dhash, m.luma_std, m.text_proxy, m.hard_invalid, m.quality_score from seeds s join fx_metrics m using (video_id, shot_id, frame_idx)",
    "changes": """select *, bit_count(xor(dhash, lag(dhash) over w)) / 64e0 as appearance, abs(luma_std - lag(luma_std) over w) / 255e0 as motion, abs(text_proxy - lag(text_proxy) over w) as txt
        from known window w as (partition by video_id, shot_id order by frame_idx)""",
    "bounds": """select video_id, shot_id, median(appearance) + 3 * greatest(mad(appearance), 1e-9) as ta, median(motion) + 3 * greatest(mad(motion), 1e-9) as tm, median(txt) + 3 * greatest(mad(txt), 1e-9) as tt
        from changes group by video_id, shot_id""",
    "flags": """select video_id, shot_id, frame_idx, list_filter([case when appearance >= ta then 'appearance_change' end, case when motion >= tm then 'motion_change' end, case when txt >= tt then 'text_change' end], lambda x: x is not null) as flags
        from changes join bounds using (video_id, shot_id)""",
    "better": """select l.video_id, l.shot_id, l.frame_idx as origin, l.quality_score as was, arg_max(n.frame_idx, (n.quality_score, -n.frame_idx)) as frame_idx, max(n.quality_score) as q
        from known l join fx_metrics n on n.video_id = l.video_id and n.shot_id = l.shot_id and abs(n.frame_idx - l.frame_idx) <= 3 and not n.hard_invalid and n.quality_score > l.quality_score
        where l.locator group by all""",
    "rescues": """select video_id, shot_id, frame_idx, gain from (select *, row_number() over (partition by video_id, shot_id order by gain desc, frame_idx) as place from
        (select video_id, shot_id, frame_idx, max(q - was) as gain from better where q - was >= 0.08e0 group by all)) join
        (select video_id, shot_id, ceil(count(*) * 0.15e0) as most from known where locator group by all) using (video_id, shot_id) where place <= most""",
    "rows0": """select coalesce(s.video_id, r.video_id) as video_id, coalesce(s.shot_id, r.shot_id) as shot_id, coalesce(s.frame_idx, r.frame_idx) as frame_idx,
        list_sort(list_distinct(list_concat(coalesce(s.reasons, []), list_concat(coalesce(f.flags, []), case when r.frame_idx is not null then ['quality_rescue'] else [] end)))) as reasons,
        coalesce(s.locator, false) as locator, r.frame_idx is not null as hard_keep
        from seeds s left join flags f using (video_id, shot_id, frame_idx) full join rescues r on r.video_id = s.video_id and r.shot_id = s.shot_id and r.frame_idx = s.frame_idx""",
    "rows1": """select r.*, m.dhash, m.quality_score, case when m.frame_idx is null then 'decode_missing' when m.hard_invalid then 'hard_invalid' end as first_verdict,
        row_number() over (partition by r.video_id, r.shot_id order by r.frame_idx) as i from rows0 r left join fx_metrics m using (video_id, shot_id, frame_idx)""",
    "fold": """select video_id, shot_id, frame_idx, i, first_verdict as rejected, case when first_verdict is null then frame_idx end as kf, case when first_verdict is null then dhash end as kh from rows1 where i = 1
        union all select video_id, shot_id, frame_idx, i, v, case when v is null then frame_idx else kf end, case when v is null then dhash else kh end from
        (select r.video_id, r.shot_id, r.frame_idx, r.i, r.dhash, f.kf, f.kh,
          case when not r.locator and not r.hard_keep and r.frame_idx - f.kf <= 8 and bit_count(xor(r.dhash, f.kh)) <= 2 then 'cheap_duplicate' else r.first_verdict end as v
        from fold f join rows1 r on r.video_id = f.video_id and r.shot_id = f.shot_id and r.i = f.i + 1)""",
    "enriched": "select r.video_id, r.shot_id, r.frame_idx, r.reasons, r.locator, r.hard_keep, r.quality_score, f.rejected from rows1 r join fold f using (video_id, shot_id, frame_idx)",
    "capacity": "select video_id, count(*) filter (where locator) as l, count(*) filter (where not locator) as c from seeds group by video_id",
    "shares": """select *, floor(exact)::bigint as base from (select video_id, l, c, (sum(c) over () // 2)::bigint as remaining, ((sum(c) over () // 2) * c)::double / (sum(c) over ())::double as exact from capacity)""",
    "plan": """select video_id, l as locator_rows, c as extra_capacity, l + base + case when row_number() over (order by exact - base desc, video_id desc) <= remaining - sum(base) over () then 1 else 0 end as target_rows from shares""",
    "admitted": """select * from (select e.*, p.target_rows - p.locator_rows as room, row_number() over (partition by e.video_id, not e.locator and e.rejected is null order by e.hard_keep desc,
        list_sum(list_transform(reasons, lambda x: case x when 'quality_rescue' then 5e0 when 'text_change' then 4e0 when 'appearance_change' then 3e0 when 'motion_change' then 2e0 when 'boundary_start' then 1e0 when 'boundary_end' then 1e0 else 0.25e0 end)) desc,
        coalesce(e.quality_score, 0e0) desc, e.frame_idx) as place from enriched e join plan p using (video_id)) where locator or (rejected is null and place <= room)""",
    "unit": "select e.*, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as u from enriched e join fx_vectors using (video_id, shot_id, frame_idx) where rejected is null",
    "pairs": """select b.video_id, b.shot_id, a.frame_idx as earlier, b.frame_idx from unit a join unit b on a.video_id = b.video_id and a.shot_id = b.shot_id and b.frame_idx - a.frame_idx between 1 and 24
        where list_dot_product(a.u, b.u) >= 0.985e0""",
    "turns": """select u.video_id, u.shot_id, u.frame_idx, u.locator or u.hard_keep as keep, coalesce(p.earlier, []) as earlier, row_number() over (partition by u.video_id, u.shot_id order by u.frame_idx) as i
        from unit u left join (select video_id, shot_id, frame_idx, list(earlier) as earlier from pairs group by all) p using (video_id, shot_id, frame_idx)""",
    "passes": """select video_id, shot_id, frame_idx, i, false as gone, [frame_idx] as kept from turns where i = 1
        union all select t.video_id, t.shot_id, t.frame_idx, t.i, not t.keep and list_has_any(p.kept, t.earlier), case when not t.keep and list_has_any(p.kept, t.earlier) then p.kept else list_append(p.kept, t.frame_idx) end
        from passes p join turns t on t.video_id = p.video_id and t.shot_id = p.shot_id and t.i = p.i + 1""",
    "cover": """select video_id, shot_id, n as length, end_frame - start_frame + 2 - n as possible,
        coalesce(sum(greatest(0, least(end_frame - n + 1, frame_idx) - greatest(start_frame, frame_idx - n + 1, coalesce(before + 1, start_frame)) + 1)), 0) as covered
        from (select s.*, l.frame_idx, lag(l.frame_idx) over (partition by s.video_id, s.shot_id order by l.frame_idx) as before from fx_shots s left join (select * from seeds where locator) l using (video_id, shot_id)),
        (values (5), (7), (9), (10), (11), (21)) t(n) where end_frame - start_frame + 2 - n > 0 group by all""",
    "coverage": """select v.video_id, n as length, coalesce(sum(covered)::double / sum(possible)::double, 1e0) as coverage, coalesce(sum(possible), 0)::bigint as weight
        from (select distinct video_id from fx_shots) v cross join (values (5), (7), (9), (10), (11), (21)) t(n) left join cover c on c.video_id = v.video_id and c.length = n group by all""",
}
_RECURSIVE = ("fold", "passes")


def _with_views(sql: str) -> str:
    """``sql`` behind those views that it needs."""
    needed, todo = set(), [sql]
    import re

    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(VIEWS[name])
    return "with recursive " + ", ".join(f"{n} as ({VIEWS[n]})" for n in VIEWS if n in needed) + " " + sql if needed else sql


def _joined(column: str):
    return F.array_join(column, ",").alias(column)


@query("select video_id, shot_id, start_frame, end_frame from fx_shots")
def q_shots(d: Data) -> DataFrame:
    return d.shots


@query("select video_id, start_frame, end_frame, kind from zones")
def q_transition_zones(d: Data) -> DataFrame:
    return d.zones


@query("""select video_id, shot_id, 'overlap' as violation from (select *, lag(e) over (partition by video_id order by start_frame) as before from (select *, end_frame + case when shot_id % 5 = 0 then 3 else 0 end as e from fx_shots)) where start_frame <= before
 union all select s.video_id, shot_id, 'bounds' from fx_shots s join fx_videos v using (video_id) where end_frame + case when shot_id % 5 = 0 then 3 else 0 end >= frame_count""")
def q_shot_violations(d: Data) -> DataFrame:
    late = F.col("end_frame") + F.when(F.col("shot_id") % 5 == 0, 3).otherwise(0)
    return boundaries.violations(d.shots.withColumn("end_frame", late), d.videos, "start_frame")


@query("select video_id from fx_videos where (starts_with(video_id, 'U0000') or starts_with(video_id, 'U0001')) and cast(regexp_extract(video_id, '(\\d+)$', 1) as int) between 10 and 120")
def q_partition_prune(d: Data) -> DataFrame:
    return boundaries.chosen(d.videos, ["U0000", "U0001"], 10, 120, r"(\d+)$").select("video_id")


@query("select f.video_id, f.frame_idx, s.shot_id from fx_frames f left join fx_shots s on s.video_id = f.video_id and f.frame_idx between s.start_frame and s.end_frame")
def q_frame_shot_lookup(d: Data) -> DataFrame:
    return boundaries.shot_of(d.frames.select("video_id", "frame_idx"), d.shots)


@query("select video_id, count(*) as n from fx_frames f where exists (select 1 from zones z where z.video_id = f.video_id and f.frame_idx between z.start_frame and z.end_frame) group by video_id")
def q_frame_in_zone(d: Data) -> DataFrame:
    return boundaries.in_zone(d.frames.select("video_id", "frame_idx"), d.zones).groupBy("video_id").agg(F.count("*").alias("n"))


@query("select video_id, shot_id, frame_idx, array_to_string(reasons, ',') as reasons, locator from seeds")
def q_seed_candidates(d: Data) -> DataFrame:
    return d.seeds.withColumn("reasons", _joined("reasons"))


@query("select reason, count(*) as n from (select unnest(reasons) as reason from seeds) group by reason")
def q_reason_counts(d: Data) -> DataFrame:
    return seeds.reason_counts(d.seeds)


@query("select distinct s.video_id, f as frame_idx from (select video_id, shot_id, unnest(generate_series(frame_idx - 3, frame_idx + 3)) as f from seeds) t join fx_shots s using (video_id, shot_id) where f between start_frame and end_frame")
def q_decode_targets(d: Data) -> DataFrame:
    return seeds.decode_targets(d.seeds, d.shots, SMALL.neighbor_radius)


@query("""select video_id, array_to_string(list_filter([case when n % 3 = 0 then 'frame_count' end, case when n % 5 = 0 then 'fps' end], lambda x: x is not null), ',') as mismatches
 from (select video_id, cast(substr(video_id, 2) as int) as n from fx_videos) where n % 3 = 0 or n % 5 = 0""")
def q_probe_mismatch(d: Data) -> DataFrame:
    n = F.substring("video_id", 2, 6).cast("int")
    observed = d.videos.withColumn("frame_count", F.col("frame_count") + F.when(n % 3 == 0, 1).otherwise(0)).withColumn("fps", F.col("fps") + F.when(n % 5 == 0, F.lit(0.002)).otherwise(F.lit(0.0005)))
    return boundaries.probe_mismatches(d.videos, observed).withColumn("mismatches", _joined("mismatches"))


_DX, _DY = "[g[i + 1] - g[i] for i in range({0}, 64) if i % 8 <> 0]", "[g[i + 8] - g[i] for i in range({0}, 57)]"
_GRID = f"""select vec_id, list_avg(g) as m, sqrt(list_var_pop(g)) as s, len([x for x in g if x <= 60e0]) / 64e0 as black, (list_var_pop({_DX.format(1)}) + list_var_pop({_DY.format(1)})) / 65025e0 as sharp,
 (list_avg([abs(x) for x in {_DX.format(33)}]) + list_avg([abs(x) for x in {_DY.format(33)}])) / 510e0 as txt,
 list_sum(list_transform(list_transform(range(0, 32), lambda b: len(list_filter(g, lambda x: x >= b * 8 and x < b * 8 + 8)) / 64e0), lambda p: case when p > 0 then -p * log2(p) else 0e0 end)) / 5 as ent from fx_grids"""


@query(f"""select vec_id, round(m, 6) as luma_mean, round(s, 6) as luma_std, black as black_ratio, round(sharp, 8) as sharpness, round(txt, 8) as text_proxy, round(ent, 8) as entropy, black >= 0.1e0 as hard_invalid,
 round(case when black >= 0.1e0 then 0e0 else 0.4e0 * least(1e0, sharp / 0.02e0) + 0.25e0 * least(1e0, ent) + 0.2e0 * greatest(0e0, 1 - abs(m - 127.5e0) / 127.5e0) + 0.15e0 * least(1e0, s / 64) end, 6) as quality_score from ({_GRID})""")
def q_grid_quality(d: Data) -> DataFrame:
    g = F.col("grid")
    bins = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: F.size(F.filter(g, lambda x: F.floor(x / 8) == b)) / F.lit(64.0))
    across, down = fn.differences(g, 8)
    low_across, low_down = fn.differences(g, 8, True)
    rows = d.grids.withColumns({"across": across, "down": down, "low_across": low_across, "low_down": low_down, "m": fn.mean(g), "s": F.sqrt(fn.variance(g)), "black_ratio": F.size(F.filter(g, lambda x: x <= 60)) / F.lit(64.0)})
    rows = rows.withColumns({
        "sharp": (fn.variance(F.col("across")) + fn.variance(F.col("down"))) / F.lit(65025.0),
        "txt": (fn.mean(F.transform("low_across", F.abs)) + fn.mean(F.transform("low_down", F.abs))) / F.lit(510.0),
        "ent": fn.total(F.transform(bins, lambda p: F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0)))) / 5, "hard_invalid": F.col("black_ratio") >= 0.1,
    })
    score = fn.quality_score(F.col("sharp"), F.col("ent"), F.col("m"), F.col("s"), F.col("hard_invalid"))
    return rows.select("vec_id", F.round("m", 6).alias("luma_mean"), F.round("s", 6).alias("luma_std"), "black_ratio", F.round("sharp", 8).alias("sharpness"), F.round("txt", 8).alias("text_proxy"), F.round("ent", 8).alias("entropy"), "hard_invalid", F.round(score, 6).alias("quality_score"))


@query("""select a.video_id, a.frame_idx, bit_count(xor(a.dhash, b.dhash))::bigint as distance from fx_metrics a join fx_metrics b on a.video_id = b.video_id and b.frame_idx = a.frame_idx - 1""")
def q_dhash_hamming(d: Data) -> DataFrame:
    b = d.metrics.select("video_id", (F.col("frame_idx") + 1).alias("frame_idx"), F.col("dhash").alias("other"))
    return d.metrics.join(b, ["video_id", "frame_idx"]).select("video_id", "frame_idx", fn.hamming(F.col("dhash"), F.col("other")).cast("bigint").alias("distance"))


@query("select vec_id, sha256(array_to_string([cast(floor(x) as int) for x in g], ',')) as sha from fx_grids")
def q_pixel_sha(d: Data) -> DataFrame:
    return d.grids.select("vec_id", F.sha2(F.array_join(F.transform("grid", lambda x: F.floor(x).cast("int").cast("string")), ","), 256).alias("sha"))


@query("select video_id, shot_id, round(ta, 9) as t_appearance, round(tm, 9) as t_motion, round(tt, 9) as t_text from bounds where ta is not null")
def q_robust_threshold(d: Data) -> DataFrame:
    t = change.thresholds(change.signals(d.known), SMALL).filter("t_appearance is not null")
    return t.select("video_id", "shot_id", *[F.round(c, 9).alias(c) for c in ("t_appearance", "t_motion", "t_text")])


@query("select video_id, shot_id, frame_idx, array_to_string(flags, ',') as flags from flags")
def q_change_flags(d: Data) -> DataFrame:
    return change.change_flags(d.known, SMALL).withColumn("flags", _joined("flags"))


@query("select video_id, shot_id, frame_idx, round(gain, 9) as gain from rescues")
def q_rescue(d: Data) -> DataFrame:
    return change.rescues(d.known, d.metrics, SMALL).withColumn("gain", F.round("gain", 9))


@query("select video_id, shot_id, frame_idx, array_to_string(reasons, ',') as reasons, locator, hard_keep, rejected from enriched")
def q_cheap_dedup(d: Data) -> DataFrame:
    return d.enriched.select("video_id", "shot_id", "frame_idx", _joined("reasons"), "locator", "hard_keep", "rejected")


@query("select rejected, count(*) as n from enriched where rejected is not null group by rejected")
def q_rejection_counts(d: Data) -> DataFrame:
    return evaluate.rejection_counts(d.enriched)


@query("select video_id, locator_rows, extra_capacity, target_rows::bigint as target_rows from plan")
def q_budget_plan(d: Data) -> DataFrame:
    return d.plan


_RESULTS = "select video_id, 0 as pos, target_rows - (n % 3) as candidate_rows, (n % 11 = 0)::int as decode_missing from (select *, cast(substr(video_id, 2) as int) as n from plan) where n % 7 <> 0 union all select 'X000001', 0, 5, 0"


@query(f"""select coalesce(p.video_id, r.video_id) as video_id, locator_rows, target_rows::bigint as requested_rows, case when p.video_id is not null then coalesce(candidate_rows, 0) end::bigint as target_rows,
 case when p.video_id is not null then greatest(0, target_rows - coalesce(candidate_rows, 0)) end::bigint as underfilled_rows,
 array_to_string(list_filter([case when p.video_id is null then 'unexpected' end, case when r.video_id is null then 'missing' end, case when decode_missing <> 0 then 'incomplete' end,
 case when coalesce(candidate_rows, 0) < locator_rows then 'below locators' end], lambda x: x is not null), ',') as failures from plan p full join ({_RESULTS}) r on r.video_id = p.video_id""")
def q_budget_reconcile(d: Data) -> DataFrame:
    return budget.reconcile(d.plan, _results(d)).withColumn("failures", _joined("failures"))


@query("select video_id, shot_id, frame_idx, locator, rejected from admitted")
def q_admission(d: Data) -> DataFrame:
    return d.admitted.select("video_id", "shot_id", "frame_idx", "locator", "rejected")


@query("select vec_id, round(u[1], 6) as first, round(u[32], 6) as last, round(list_dot_product(u, u), 6) as size from (select vec_id, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) as u from (select vec_id, list_transform(embedding[1:32], lambda x: x::double) as w from embeddings))")
def q_search_view(d: Data) -> DataFrame:
    u = d.spark.read.parquet(f"{d.dir}/embeddings.parquet").select("vec_id", fn.search_view(F.col("embedding"), SMALL.search_dim).alias("u"))
    return u.select("vec_id", F.round(F.get("u", F.lit(0)), 6).alias("first"), F.round(F.get("u", F.lit(31)), 6).alias("last"), F.round(fn.dot(F.col("u"), F.col("u")), 6).alias("size"))


@query("""select count(n) as vectors, count(*) filter (where n is null) as missing, count(*) filter (where wanted is null) as unexpected, count(*) filter (where dim <> 64) as wrong_dim, count(*) filter (where isnan(n) or isinf(n)) as not_finite,
 count(*) filter (where abs(n - 1) > 2e-3) as not_unit, round(min(n) filter (where not isnan(n)), 4) as norm_min from (select video_id, frame_idx, true as wanted from admitted) a full join
 (select video_id, frame_idx, case when frame_idx % 17 = 3 then 'nan'::double else (case when frame_idx % 11 = 3 then 2e0 else 1e0 end) * sqrt(list_dot_product(w, w)) end as n, len(w) as dim
  from (select video_id, frame_idx, case when frame_idx % 13 = 5 then v[1:63] else v end as w from fx_vectors)) f using (video_id, frame_idx)""")
def q_vector_integrity(d: Data) -> DataFrame:
    """Vectors with faults: some too long, some short of a dimension, some not finite."""
    factor = F.when(F.col("frame_idx") % 17 == 3, F.lit(float("nan"))).when(F.col("frame_idx") % 11 == 3, 2.0).otherwise(1.0)
    cut = F.when(F.col("frame_idx") % 13 == 5, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    r = vectors.integrity(d.admitted, d.vectors.withColumn("embedding", F.transform(cut, lambda x: x.cast("double") * factor)), SMALL)
    return r.select("vectors", "missing", "unexpected", "wrong_dim", "not_finite", "not_unit", F.round("norm_min", 4).alias("norm_min"))


@query("""select count(n) as vectors, count(*) filter (where n is null) as missing, count(*) filter (where wanted is null) as unexpected, round(min(n), 4) as norm_min, round(max(n), 4) as norm_max,
 array_to_string(list_filter([case when count(*) filter (where n is null) > 0 then 'missing' end, case when count(*) filter (where wanted is null) > 0 then 'unexpected' end, case when count(*) filter (where dim <> 64) > 0 then 'wrong_dim' end,
 case when count(*) filter (where isnan(n) or isinf(n)) > 0 then 'not_finite' end, case when count(*) filter (where abs(n - 1) > 2e-3) > 0 then 'not_unit' end], lambda x: x is not null), ',') as failures
 from (select video_id, frame_idx, true as wanted from admitted) a full join (select video_id, frame_idx, sqrt(list_dot_product(v, v)) as n, len(v) as dim from fx_vectors) f using (video_id, frame_idx)""")
def q_vector_match(d: Data) -> DataFrame:
    r = vectors.integrity(d.admitted, d.vectors, SMALL)
    return r.select("vectors", "missing", "unexpected", F.round("norm_min", 4).alias("norm_min"), F.round("norm_max", 4).alias("norm_max"), _joined("failures"))


@query("select video_id, shot_id, earlier, frame_idx from pairs")
def q_semantic_pairs(d: Data) -> DataFrame:
    return vectors.similar_pairs(d.candidates.filter("rejected is null"), SMALL).drop("cosine")


@query("select video_id, shot_id, frame_idx from passes where gone")
def q_semantic_dedup(d: Data) -> DataFrame:
    return d.twins


@query("""select video_id, shot_id, -(max((u, -frame_idx))[2]) as frame_idx, round(max((u, -frame_idx))[1], 9) as utility from (select *, case when hard_keep then 1e0 else 0e0 end + coalesce(quality_score, 0e0) + least(0.3e0, 0.05e0 * len(reasons)) as u from enriched where rejected is null) group by video_id, shot_id""")
def q_shot_best(d: Data) -> DataFrame:
    return select.best_of_shots(d.enriched).withColumn("utility", F.round("utility", 9))


@query()
def q_select_views(d: Data) -> DataFrame:
    return d.views


@query()
def q_gap_repair(d: Data) -> DataFrame:
    return d.views.filter("source = 'gap'").select("video_id", "shot_id", "frame_idx")


@query()
def q_quota_fill(d: Data) -> DataFrame:
    return d.views.filter("source = 'quota'").select("video_id", "shot_id", "frame_idx")


@query("select video_id, length, coverage, weight from coverage")
def q_window_coverage(d: Data) -> DataFrame:
    return seeds.window_coverage(d.shots, d.seeds)


@query("select length, round(coalesce(sum(coverage * weight) / nullif(sum(weight), 0), 1e0), 9) as coverage from coverage group by length")
def q_weighted_coverage(d: Data) -> DataFrame:
    return seeds.weighted_coverage(d.shots, d.seeds).withColumn("coverage", F.round("coverage", 9))


@query("""select video_id, shot_id, greatest(min(frame_idx) - start_frame, coalesce(max(step), 0), end_frame - max(frame_idx)) as max_gap from (select s.*, l.frame_idx, l.frame_idx - lag(l.frame_idx) over (partition by s.video_id, s.shot_id order by l.frame_idx) as step
 from fx_shots s join seeds l using (video_id, shot_id) where l.locator) group by video_id, shot_id, start_frame, end_frame""")
def q_max_gap(d: Data) -> DataFrame:
    return seeds.max_gap(d.shots, d.seeds)


@query("select min(n) as least, " + ", ".join(f"round(quantile_cont(n, {q}), 6) as {k}" for k, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9), ("p99", 0.99))) + ", max(n) as most from (select end_frame - start_frame + 1 as n from fx_shots)")
def q_percentiles(d: Data) -> DataFrame:
    return seeds.length_percentiles(d.shots).withColumns({k: F.round(k, 6) for k in ("p10", "p50", "p90", "p99")})


_RANKED = "select video_id, shot_id, frame_idx, row_number() over (partition by video_id order by frame_idx) as n from seeds where locator"


@query(f"select r.video_id, n, frame_idx, r.shot_id, start_frame as shot_start_frame, end_frame as shot_end_frame, fps, frame_idx / fps as pts_time from ({_RANKED}) r join fx_shots using (video_id, shot_id) join fx_videos v on v.video_id = r.video_id")
def q_keyframe_rank(d: Data) -> DataFrame:
    return publish.keyframes(d.seeds.withColumn("discovery", F.col("locator")), d.shots, d.videos)


def _ranked(d: Data) -> DataFrame:
    return publish.keyframes(d.seeds.withColumn("discovery", F.col("locator")), d.shots, d.videos).select("video_id", "n", "frame_idx")


@query(f"select video_id, n, frame_idx, row_number() over (order by video_id, n) - 1 as row_id from ({_RANKED})")
def q_flat_index(d: Data) -> DataFrame:
    return publish.flat_index(_ranked(d))


@query(f"select video_id, (sum(c) over (order by video_id) - c)::bigint as begin, (sum(c) over (order by video_id))::bigint as finish from (select video_id, count(*) as c from ({_RANKED}) group by video_id)")
def q_ranges(d: Data) -> DataFrame:
    return publish.ranges(_ranked(d))


_DONE = "select video_id, stage, sha256(video_id || stage) as sha256, case when n % 13 = 0 then 'old' else 'now' end as fingerprint, n from (select video_id, cast(substr(video_id, 2) as int) as n from fx_videos), (values ('candidate', 2), ('vector', 3), ('selection', 5)) t(stage, k) where n % k <> 0"


def _checkpoints(d: Data) -> DataFrame:
    """Made-up checkpoints: each stage leaves out some videos, and some digests are changed or gone later."""
    n = F.substring("video_id", 2, 6).cast("int")
    stages = F.explode(F.create_map(*[F.lit(x) for x in ("candidate", 2, "vector", 3, "selection", 5)])).alias("stage", "k")
    rows = d.videos.select("video_id", n.alias("n"), stages).filter("n % k <> 0")
    return rows.select("video_id", "stage", F.sha2(F.concat("video_id", "stage"), 256).alias("sha256"), F.when(F.col("n") % 13 == 0, "old").otherwise("now").alias("fingerprint"), "n")


def _actual(d: Data) -> DataFrame:
    rows = _checkpoints(d).filter("n % 17 <> 0")
    return rows.withColumn("sha256", F.when(F.col("n") % 19 == 0, F.lit("changed")).otherwise(F.col("sha256")))


@query(f"select video_id from fx_videos where video_id not in (select video_id from ({_DONE}) where stage = 'selection')")
def q_missing_videos(d: Data) -> DataFrame:
    return publish.missing(d.videos, _checkpoints(d).filter("stage = 'selection'"))


@query(f"select video_id, stage, case when n % 17 = 0 then 'gone' else 'changed' end as failure from ({_DONE}) where n % 17 = 0 or n % 19 = 0")
def q_checkpoint_audit(d: Data) -> DataFrame:
    return publish.audit(_checkpoints(d), _actual(d))


@query(f"select video_id from fx_videos where video_id not in (select video_id from ({_DONE}) where stage = 'vector' and fingerprint = 'now' and n % 17 <> 0 and n % 19 <> 0)")
def q_recovery(d: Data) -> DataFrame:
    return publish.todo(d.videos, _checkpoints(d), _actual(d), "now", "vector")


@query(f"select stage, count(distinct video_id) as done, (select count(*) from fx_videos) - count(distinct video_id) as left from ({_DONE}) group by stage".replace("as left", 'as "left"'))
def q_status(d: Data) -> DataFrame:
    return publish.status(d.videos, _checkpoints(d))


_USABLE = "(select video_id, shot_id, frame_idx from admitted where locator and rejected is distinct from 'decode_missing')"


@query(f"""select video_id, 'duplicate frame' as failure, count(*) as n from (select video_id from admitted group by video_id, frame_idx having count(*) > 1) group by video_id
 union all select a.video_id, 'outside its shot', count(*) from admitted a left join fx_shots s using (video_id, shot_id) where s.start_frame is null or a.frame_idx not between s.start_frame and s.end_frame group by a.video_id
 union all select a.video_id, 'inside a zone', count(*) from admitted a where exists (select 1 from zones z where z.video_id = a.video_id and a.frame_idx between z.start_frame and z.end_frame) group by a.video_id
 union all select video_id, 'shot without locator', count(*) from fx_shots s where not exists (select 1 from {_USABLE} u where u.video_id = s.video_id and u.shot_id = s.shot_id) group by video_id
 union all select video_id, 'shot without eligible frame', count(*) from fx_shots s where not exists (select 1 from admitted a where a.video_id = s.video_id and a.shot_id = s.shot_id and a.rejected is null) group by video_id
 union all select video_id, 'locator gap over stride', count(*) from (select video_id, case when max(frame_idx) is null then end_frame - start_frame + 1 else greatest(min(frame_idx) - start_frame, coalesce(max(step), 0), end_frame - max(frame_idx)) end as gap
  from (select s.*, u.frame_idx, u.frame_idx - lag(u.frame_idx) over (partition by s.video_id, s.shot_id order by u.frame_idx) as step from fx_shots s left join {_USABLE} u using (video_id, shot_id)) group by video_id, shot_id, start_frame, end_frame) where gap > 4 group by video_id
 union all select distinct video_id, 'answer window not covered', 1 from (select video_id, shot_id, unnest(generate_series(start_frame, end_frame - 3)) as b from fx_shots) w
  where not exists (select 1 from {_USABLE} u where u.video_id = w.video_id and u.shot_id = w.shot_id and u.frame_idx between b and b + 3)
 union all select p.video_id, 'rows differ from the plan', 1 from plan p left join (select video_id, count(*) as c from admitted group by video_id) a using (video_id) where coalesce(c, 0) <> target_rows
 union all select video_id, 'decode missing', count(*) from admitted where rejected = 'decode_missing' group by video_id""")
def q_candidate_gate(d: Data) -> DataFrame:
    return evaluate.candidate_failures(fx.written(d.admitted), d.shots, d.zones, d.plan, SMALL)


@query("""select s.*, s.seed_rows + s.rescue_bound as row_bound, (s.seed_rows + s.rescue_bound) * 128e0 / 1073741824e0 as gib_bound from (select sum(n)::bigint as seed_rows, sum(l)::bigint as locator_rows, sum(ceil(l * 0.15e0))::bigint as rescue_bound,
 (select count(*) from (select distinct s.video_id, f from (select video_id, shot_id, unnest(generate_series(frame_idx - 3, frame_idx + 3)) as f from seeds) t join fx_shots s using (video_id, shot_id) where f between start_frame and end_frame)) as decode_rows
 from (select count(*) as n, count(*) filter (where locator) as l from seeds group by video_id, shot_id)) s""")
def q_sampling_report(d: Data) -> DataFrame:
    return evaluate.sampling_report(d.seeds, seeds.decode_targets(d.seeds, d.shots, SMALL.neighbor_radius), SMALL)


@query("select s.video_id, shot_id, frame_idx, greatest(start_frame, least(frame_idx + 5, end_frame)) as later from seeds s join fx_shots using (video_id, shot_id)")
def q_clamped(d: Data) -> DataFrame:
    return d.seeds.join(d.shots, change.SHOT).select(*change.FRAME, fn.clamped(F.col("frame_idx") + 5).alias("later"))


@query("select video_id, frame_idx, frame_idx // 8 as cluster_id from enriched")
def q_cluster_ids(d: Data) -> DataFrame:
    return d.enriched.select("video_id", "frame_idx", fn.cluster_id(F.col("frame_idx"), SMALL.cluster_radius).alias("cluster_id"))


@query("select video_id, frame_idx, count(*) as n from (select video_id, frame_idx from seeds union all select video_id, frame_idx from rescues union all select video_id, frame_idx from fx_metrics where hard_invalid) group by all having count(*) > 1")
def q_duplicate_keys(d: Data) -> DataFrame:
    keys = ["video_id", "frame_idx"]
    rows = d.seeds.select(*keys).unionByName(change.rescues(d.known, d.metrics, SMALL).select(*keys)).unionByName(d.metrics.filter("hard_invalid").select(*keys))
    return evaluate.duplicate_keys(rows, keys)


_RECONCILED = f"""(select p.video_id, locator_rows, extra_capacity, target_rows as requested_rows, coalesce(candidate_rows, 0)::bigint as actual,
 (r.video_id is null)::int + (coalesce(decode_missing, 0) <> 0)::int + (coalesce(candidate_rows, 0) < locator_rows)::int as failures from plan p left join ({_RESULTS}) r on r.video_id = p.video_id)"""


def _results(d: Data) -> DataFrame:
    n = F.substring("video_id", 2, 6).cast("int")
    results = d.plan.filter(n % 7 != 0).select("video_id", F.lit(0).alias("pos"), (F.col("target_rows") - n % 3).alias("candidate_rows"), (n % 11 == 0).cast("int").alias("decode_missing"))
    return results.unionByName(d.spark.createDataFrame([("X000001", 0, 5, 0)], "video_id string, pos int, candidate_rows bigint, decode_missing int"))


@query(f"""select sum(locator_rows)::bigint as locator_rows, sum(requested_rows)::bigint as requested_assigned_rows, sum(actual)::bigint as assigned_rows, (sum(failures) + 1)::bigint as failures, (sum(actual) - sum(locator_rows))::bigint as source_extra_rows,
 (sum(requested_rows) - sum(actual))::bigint as underfilled_rows, 'fail' as status from {_RECONCILED}""")
def q_budget_totals(d: Data) -> DataFrame:
    return budget.totals(budget.reconcile(d.plan, _results(d)))


@query(f"select video_id, locator_rows, extra_capacity, requested_rows::bigint as requested_rows, actual as target_rows, greatest(0, requested_rows - actual)::bigint as underfilled_rows from {_RECONCILED} where failures = 0")
def q_final_plan(d: Data) -> DataFrame:
    return budget.finalised(d.plan, _results(d))


@query("select video_id, target_rows::bigint as target_rows, row_number() over (order by target_rows desc, video_id) as place from plan")
def q_longest_first(d: Data) -> DataFrame:
    return budget.longest_first(d.plan)


@query(f"""select failure, array_to_string(list_sort(list(video_id) filter (where place <= 5)), ',') as videos, count(*) as n from (select *, row_number() over (partition by failure order by video_id) as place from
 (select distinct video_id, kind as failure from zones union all select distinct video_id, 'shot of one frame' from fx_shots where start_frame = end_frame)) group by failure""")
def q_first_failures(d: Data) -> DataFrame:
    failures = d.zones.select("video_id", F.col("kind").alias("failure")).unionByName(d.shots.filter("start_frame = end_frame").select("video_id", F.lit("shot of one frame").alias("failure")))
    return evaluate.first_of(failures).withColumn("videos", _joined("videos"))


@query("""select video_id, sum(frame_count)::bigint as rows, sum(seconds) as seconds, round(sum(frame_count) / sum(seconds), 9) as rate from (select video_id, frame_count, (1 + cast(substr(video_id, 2) as int) % 4) * 0.25e0 as seconds from fx_videos) group by rollup (video_id)""")
def q_throughput(d: Data) -> DataFrame:
    seconds = (1 + F.substring("video_id", 2, 6).cast("int") % 4) * F.lit(0.25)
    return evaluate.throughput(d.videos.select("video_id", F.col("frame_count").alias("rows"), seconds.alias("seconds"))).withColumn("rate", F.round("rate", 9))


@query("""select video_id, frame_idx, 'missing' as side from (select video_id, frame_idx from fx_metrics except select video_id, frame_idx from admitted)
 union all select video_id, frame_idx, 'unexpected' from (select video_id, frame_idx from admitted except select video_id, frame_idx from fx_metrics)""")
def q_set_differences(d: Data) -> DataFrame:
    return evaluate.set_differences(d.admitted, d.metrics, ["video_id", "frame_idx"])


@query("select format('L{:02d}_V{:03d}', g, i) as video_id from range(21, 24) a(g), range(1, 1001) b(i)")
def q_video_ids(d: Data) -> DataFrame:
    ids = [boundaries.video_ids(d.spark, f"L{g}", 1, 1000) for g in (21, 22, 23)]
    return ids[0].unionByName(ids[1]).unionByName(ids[2])


@query(f"select video_id, cast(n as varchar) as n, frame_idx from ({_RANKED})")
def q_index_ids(d: Data) -> DataFrame:
    return _ranked(d).select(fn.index_id(F.col("video_id"), F.col("n")).alias("id"), "frame_idx").select("id.*", "frame_idx")


@query("""select video_id, frame_idx, shot_id, array_to_string(reasons, ',') as reasons, locator as locator_keep, hard_keep, frame_idx // 8 as cluster_id, quality_score, rejected is null as selected, rejected as rejected_reason from enriched""")
def q_candidate_records(d: Data) -> DataFrame:
    """Candidates written as JSON objects and read again."""
    lacking = [F.lit(None).cast(k).alias(c) for c, k in (("pixel_sha256", "string"), ("dhash", "bigint"), *[(c, "double") for c in ("luma_mean", "luma_std", "black_ratio", "sharpness", "entropy", "text_proxy")])]
    metrics = F.when(F.col("quality_score").isNotNull(), F.struct(*lacking, "quality_score", F.lit(False).alias("hard_invalid")))
    fields = ["video_id", "frame_idx", "shot_id", F.reverse("reasons").alias("reasons"), F.col("locator").alias("locator_keep"), "hard_keep", "cluster_id", metrics.alias("metrics"), F.col("rejected").isNull().alias("selected"), F.col("rejected").alias("rejected_reason")]
    back = d.enriched.select(fn.from_record(fn.to_record(F.struct(*fields))).alias("c")).select("c.*")
    return back.withColumns({"reasons": F.array_join("reasons", ","), "quality_score": F.col("metrics.quality_score")}).drop("metrics")
