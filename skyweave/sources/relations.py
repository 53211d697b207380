"""Scene, pixel, keypoint and label relations derived from the given tables; the SQL runs unchanged in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("supplier", "lineitem", "orders", "events")

#: In the order in which they build on each other.
RELATIONS = {
    "scene_meta": """
select concat('movement_', case b % 5 when 0 then 'a380_800' when 1 then '777_300er' when 2 then '737_max8' when 3 then 'b787_9' else 'a320' end, '__run', lpad(cast(b as varchar(10)), 3, '0')) as bag_stem,
       concat('movement_', case b % 5 when 0 then 'a380_800' when 1 then '777_300er' when 2 then '737_max8' when 3 then 'b787_9' else 'a320' end, '__run', lpad(cast(b as varchar(10)), 3, '0'), '__scene_', lpad(cast(k as varchar(10)), 6, '0')) as unique_scene,
       case b % 5 when 0 then 'a380_800' when 1 then '777_300er' when 2 then '737_max8' when 3 then 'b787_9' else 'a320' end as profile,
       k as scene_key, 16 as h, 64 as w
from (select s_suppkey as k, cast(floor(sqrt(cast(s_suppkey as double))) as bigint) as b from supplier) q
""",
    "px": """
select m.unique_scene, m.bag_stem, q.row_idx, q.col_idx, q.x, q.y, q.z, q.rng as range_m, q.intensity, q.reflectivity, q.is_ground, q.is_aircraft
from (select l_suppkey as scene_key, l_partkey % 16 as row_idx, (l_orderkey * 7 + l_linenumber) % 64 as col_idx,
        cast((l_partkey * 31 + l_orderkey * 17) % 4001 - 2000 as double) / 100 as x,
        cast((l_partkey * 13 + l_orderkey * 29) % 4001 - 2000 as double) / 100 as y,
        cast((l_partkey * 7 + l_orderkey * 3) % 601 - 100 as double) / 100 as z,
        l_quantity as rng,
        cast((l_orderkey * 97) % 65536 as double) as intensity, cast((l_partkey * 89) % 65536 as double) as reflectivity,
        (l_linenumber = 1) as is_ground, (l_returnflag = 'R' and (l_orderkey * 7 + l_linenumber) % 64 not between 20 and 33) as is_aircraft,
        row_number() over (partition by l_suppkey, l_partkey % 16, (l_orderkey * 7 + l_linenumber) % 64 order by l_quantity, l_orderkey, l_linenumber, l_partkey) as rn
      from lineitem) q
join scene_meta m on m.scene_key = q.scene_key
where q.rn = 1
""",
    "kp3d": """
select m.unique_scene, t.kp_idx, t.kp_name,
       cast(case m.scene_key % 4 when 0 then t.lx when 1 then -t.ly when 2 then -t.lx else t.ly end + m.scene_key % 11 - 5 as double) as x,
       cast(case m.scene_key % 4 when 0 then t.ly when 1 then t.lx when 2 then -t.ly else -t.lx end + m.scene_key % 7 - 3 as double) as y,
       cast(t.lz + m.scene_key % 3 as double) as z
from scene_meta m cross join (values (0,'center',0,0,0),(1,'left_wing_tip',0,15,1),(2,'right_wing_tip',0,-15,1),
  (3,'plane_front_left_wheel_link',10,1,-2),(4,'plane_front_right_wheel_link',10,-1,-2),(5,'plane_rear_left_wheel_link',-5,4,-2),
  (6,'plane_rear_right_wheel_link',-5,-4,-2),(7,'engine_left',3,6,-1),(8,'engine_right',3,-6,-1)) t(kp_idx,kp_name,lx,ly,lz)
""",
    "crop_boxes": """
select p.profile, t.name, t.warning_level, cast(t.x as double) as x, cast(t.y as double) as y, cast(t.z as double) as z,
       cast(0 as double) as rx, cast(0 as double) as ry, cast(0 as double) as rz,
       cast(t.sx as double) as sx, cast(t.sy as double) as sy, cast(t.sz as double) as sz
from (select distinct profile from scene_meta) p cross join (values ('engine_left',5,3,6,-1,4,3,3),('engine_right',5,3,-6,-1,4,3,3),
  ('front_landing_gear_left',4,10,1,-2,2,2,2),('front_landing_gear_right',4,10,-1,-2,2,2,2),('left_wing',5,0,12,1,6,8,2),('rear_wing',3,-12,0,1,3,9,2)) t(name,warning_level,x,y,z,sx,sy,sz)
where not (p.profile = '777_300er' and t.name = 'engine_right')
""",
    "pose_label_lines": """
select m.bag_stem, m.unique_scene, case o.o_orderkey % 10 when 8 then 'val' when 9 then 'test' else 'train' end as split,
       o.o_orderkey as line_no,
       concat('0 0.', lpad(cast(o.o_orderkey % 1000 as varchar(10)),3,'0'), ' 0.', lpad(cast(o.o_custkey % 1000 as varchar(10)),3,'0'),
              ' 0.', lpad(cast(o.o_orderkey % 400 + 20 as varchar(10)),3,'0'), ' 0.', lpad(cast(o.o_custkey % 300 + 20 as varchar(10)),3,'0'),
              ' 0.', lpad(cast((o.o_orderkey * 3) % 1000 as varchar(10)),3,'0'), ' 0.', lpad(cast((o.o_orderkey * 7) % 1000 as varchar(10)),3,'0'), ' ', cast(o.o_orderkey % 2 as varchar(2)),
              ' 0.', lpad(cast((o.o_orderkey * 11) % 1000 as varchar(10)),3,'0'), ' 0.', lpad(cast((o.o_orderkey * 13) % 1000 as varchar(10)),3,'0'), ' 1',
              case when o.o_orderkey % 97 = 0 then ' 0.5' else concat(' 0.', lpad(cast((o.o_orderkey * 17) % 1000 as varchar(10)),3,'0'), ' 0.500 ', cast((o.o_orderkey + 1) % 2 as varchar(2))) end) as text
from orders o join scene_meta m on m.scene_key = o.o_custkey % (select count(*) from supplier)
""",
    "detections": """
select m.unique_scene, case when e.event_id % 3 = 0 then 'h5_rgb' else 'image' end as det_source, e.event_id as det_idx,
       case e.event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as cls,
       e.value / 500 as conf,
       cast(e.event_id % 40 - 2 as double) as x1, cast(e.user_id % 10 - 1 as double) as y1,
       cast(e.event_id % 40 - 2 + e.user_id % 30 as double) as x2, cast(e.user_id % 10 - 1 + e.event_id % 9 as double) as y2
from events e join scene_meta m on m.scene_key = e.user_id % (select count(*) from supplier)
""",
    "kp_error": """
select m.unique_scene, e.event_type as kp_name, e.value / 100 as error_l2_m,
       case e.event_id % 4 when 0 then 'pseudo_2d' when 1 then 'exact' when 2 then 'alias' else '' end as gt_source,
       case when e.event_id % 10 = 0 then 'pcd_not_found' when e.event_id % 17 = 0 then 'gt_match_not_found' else 'ok' end as status, e.event_id as row_id
from events e join scene_meta m on m.scene_key = e.user_id % (select count(*) from supplier)
""",
}
NEEDS = {name: [x for x in RELATIONS if x != name and x in sql] for name, sql in RELATIONS.items()}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived relation over the tables in sf_dir."""
    for table in BASE:
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        # pixels are dealt by scene before they are made: once for their ranks and for their scene's row, as the few columns they come from
        (rows.repartition("l_suppkey") if table == "lineitem" else rows).createOrReplaceTempView(table)
    for need in NEEDS[name]:
        spark.sql(RELATIONS[need]).createOrReplaceTempView(need)
    return spark.sql(RELATIONS[name])


def with_relations(sql: str, *names: str) -> str:
    """The SQL with the relations it reads in front, as common table expressions."""
    wanted = [n for n in RELATIONS if n in names or any(n in NEEDS[x] for x in names)]
    body = ", ".join(f"{n} as ({RELATIONS[n].strip()})" for n in wanted)
    for start in ("with recursive ", "with "):
        if sql.startswith(start):
            return f"{start}{body}, {sql.removeprefix(start)}"
    return f"with {body} {sql}"
