"""Choice of files, profiles, records and instances by name, order or score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.names import aircraft_token, norm_name, scene_bag, scene_name
from skyweave.operators.ranks import ranked

#: Rows from the top that each task may hold and that may meet in one.
TOP = 100_000


def _apart(text: Column, left: str, right: str, by: str) -> Column:
    return F.regexp_replace(text, f"({left})({right})", f"$1{by}$2")


def slug_candidates(bag: Column, profile: Column) -> Column:
    """Slugs under which a recording's boxes may be filed, likeliest first: of the profile and the aircraft token, as they are, parted between
    letters and digits, without a leading b; each also with `max_` joined and without `_split`."""

    def spelled(seed: Column) -> Column:
        bare = F.when(seed.rlike("^[bB][0-9]"), F.substring(seed, 2, 1000))
        return F.array(seed, _apart(seed, "[A-Za-z]", "[0-9]", "_"), _apart(seed, "[0-9]", "[A-Za-z]", "_"), bare)

    slugs = F.transform(F.concat(spelled(F.trim(profile)), spelled(F.trim(aircraft_token(bag)))), lambda s: norm_name(s, "slug"))
    variants = lambda s: F.array(s, F.regexp_replace(s, "max_", "max"), F.when(s.endswith("_split"), F.regexp_replace(s, "_split$", "")))
    every = F.flatten(F.transform(F.filter(slugs, lambda s: s.isNotNull()), variants))
    return F.array_distinct(F.filter(every, lambda s: s.isNotNull() & (s != "")))


def infer_profile(stems: DataFrame, catalogue: DataFrame, width: int = 3) -> DataFrame:
    """Adds profile, or null: the catalogue's profile whose key is the first match among the stem's aircraft token without trailing `split` and `fix`,
    the stem, and its runs of 3, 2 and 1 words that hold a digit. Each is tried as it is, without a leading b, and parted
    between digits and letters."""
    stem = F.trim("stem")
    token = F.regexp_replace(F.regexp_extract(stem, "(?i)^movement_(.+?)(?:__|$)", 1), "(?i)(_+(split|fix))+_*$", "")
    words = F.filter(F.split(stem, "[^A-Za-z0-9]+"), lambda t: t != "")
    runs = F.flatten(F.transform(words, lambda t, i: F.array(*(F.when(i + w <= F.size(words), F.array_join(F.slice(words, i + 1, w), "_")) for w in range(width, 0, -1)))))
    seeds = F.concat(F.array(token, stem), F.filter(runs, lambda r: r.rlike("[0-9]")))

    def spelled(seed: Column) -> Column:
        bare = F.when(seed.rlike("^[bB][0-9]"), F.substring(seed, 2, 1000))
        return F.array(seed, bare, _apart(seed, "[0-9]", "[A-Za-z]", "_"), _apart(seed, "[A-Za-z]", "[0-9]", "_"), F.regexp_replace(seed, "([A-Za-z]+)([0-9]+)$", "$1_$2"))

    tried = stems.select("stem").distinct().select("stem", F.posexplode(F.flatten(F.transform(seeds, spelled))).alias("at", "key")).where("key is not null and key <> ''")
    known = catalogue.select(norm_name(F.col("profile"), "key").alias("key"), "profile")
    found = tried.withColumn("key", norm_name(F.col("key"), "key")).join(known, "key").groupBy("stem").agg(F.min_by("profile", F.struct("at", "profile")).alias("profile"))
    return stems.join(found, "stem", "left")


def match_scene_requests(images: DataFrame, sources: DataFrame) -> DataFrame:
    """Images (stem) with scene, the first path of the source (path) whose file is named as their recording, and reason: ok, bad_stem or
    missing_source."""
    named = sources.groupBy(F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("_bag")).agg(F.min("path").alias("path"))
    placed = images.withColumn("scene", scene_name(F.col("stem"))).withColumn("_bag", scene_bag(F.col("stem"))).join(named, "_bag", "left")
    reason = F.when(F.col("_bag").isNull(), "bad_stem").when(F.col("path").isNull(), "missing_source").otherwise("ok")
    return placed.withColumn("reason", reason).drop("_bag")


def reuse_labels(scenes: DataFrame, files: DataFrame, root: str, strict: bool = False) -> DataFrame:
    """Scenes (unique_scene, split) with the label file (path) to reuse: one that lies where labels of the split are kept under the root, else the
    one of best score (a labels folder 10, the split's 5), then the shorter and the greater path. strict drops scenes without one."""
    stem = F.regexp_extract("path", r"([^/]*)\.txt$", 1)
    met = scenes.join(files.select("path", stem.alias("unique_scene")), "unique_scene", "left")
    ends = [F.concat(F.lit(f"{root}/labels/"), "split", F.lit("/")), F.lit(f"{root}/labels/"), F.concat(F.lit(f"{root}/"), "split", F.lit("/")), F.lit(f"{root}/")]
    tier = F.lit(0)
    for rank, folder in reversed(list(enumerate(ends))):
        tier = F.when(F.col("path") == F.concat(folder, "unique_scene", F.lit(".txt")), len(ends) - rank).otherwise(tier)
    parts = F.split(F.lower("path"), "/")
    score = F.array_contains(parts, "labels").cast("int") * 10 + F.array_contains(parts, F.lower("split")).cast("int") * 5
    best = met.groupBy("unique_scene", "split").agg(F.max(F.when(F.col("path").isNotNull(), F.struct(tier.alias("tier"), score.alias("score"), (-F.length("path")).alias("n"), "path"))).alias("b"))
    out = best.select("unique_scene", "split", F.col("b.path").alias("path"), (F.col("b.tier") > 0).alias("direct"))
    return out.where("path is not null") if strict else out


def resolve_candidates(requests: DataFrame, candidates: Column, files: DataFrame, key: str) -> DataFrame:
    """Adds path and tried_at: the first of each request's candidate paths that is among the files, or null."""
    tried = requests.select(key, F.posexplode(candidates).alias("_at", "path"))
    found = tried.join(files.select("path").distinct(), "path").groupBy(key).agg(F.min(F.struct("_at", "path")).alias("b"))
    return requests.join(found, key, "left").withColumn("path", F.col("b.path")).withColumn("tried_at", F.col("b._at")).drop("b")


def dedupe_bags(rows: DataFrame, order: str) -> DataFrame:
    """(bag_stem, n_scenes, split) of each recording's first row: a count that isn't a number is 0, the split in lower case."""
    first = rows.groupBy("bag_stem").agg(F.min_by(F.struct("n_scenes", "split"), order).alias("b"))
    return first.select("bag_stem", F.coalesce(F.trim("b.n_scenes").try_cast("int"), F.lit(0)).alias("n_scenes"), F.lower(F.coalesce("b.split", F.lit(""))).alias("split"))


def normalize_pose_records(records: DataFrame, require_final: bool = True) -> DataFrame:
    """Pose records (scene_name, unique_scene, bag_name, pcd_file, final_graph_detected, text) with blank fields filled from the others, and
    pose_result and pose_reason."""
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    kept = {c: text(c) for c in ("scene_name", "unique_scene", "bag_name", "final_graph_detected")}
    file_stem = F.regexp_extract(text("pcd_file"), r"([^/]*?)(\.[^./]*)?$", 1)
    scene = F.when(kept["scene_name"] != "", kept["scene_name"]).otherwise(file_stem)
    joined = F.when((kept["bag_name"] != "") & scene.startswith("scene_"), F.concat(kept["bag_name"], F.lit("__"), scene)).otherwise(scene)
    unique = F.when(kept["unique_scene"] != "", kept["unique_scene"]).otherwise(joined)
    final = F.lower(kept["final_graph_detected"]).isin("yes", "true", "1", "detected")
    failed = F.lit(require_final) & ~final
    bag = F.when(kept["bag_name"] != "", kept["bag_name"]).when(unique.contains("__scene_"), F.substring_index(unique, "__scene_", 1)).otherwise("")
    named = F.when(kept["scene_name"] != "", kept["scene_name"]).when(scene.contains("__scene_"), F.regexp_extract(scene, "^.*?__(.*)$", 1)).otherwise(scene)
    flag = F.when(kept["final_graph_detected"] != "", F.col("final_graph_detected")).otherwise(F.when(final, "detected").otherwise("not_detected"))
    new = {"scene_name": named, "unique_scene": unique, "bag_name": bag, "final_graph_detected": flag, "pose_result": F.when(failed, "FAIL").otherwise("PASS"), "pose_reason": F.when(failed, "no_final_graph").otherwise("ok")}
    return records.withColumns(new)


def page(rows: DataFrame, order: list[str], start: int = 0, most: int | None = None, seed: int | None = None) -> DataFrame:
    """The rows from `start` on, at most `most`, by the order, which has to be total, or by a hash of it and the seed. Few rows from the top are
    picked by every task; else rows are ranked where they lie, and none but the page's own move on."""
    by, start = order if seed is None else [F.xxhash64(F.lit(seed), *order), *order], max(0, start)
    if most is not None and start + most <= TOP:
        return rows.orderBy(*by).offset(start).limit(most)
    at = F.col("_rank")
    return ranked(rows, by, "_rank").where((at >= start) & (F.lit(True) if most is None else at < start + most)).drop("_rank")


def int_set(text: str) -> list[int]:
    """The distinct numbers of a comma-separated list, in order."""
    return list(dict.fromkeys(int(t) for t in text.split(",") if t.strip()))


def class_ids(text: str) -> dict[str, int]:
    """Names and ids of a list `name:id, ...`; an id outside 1 to 255 is an error."""
    out = {k.strip(): int(v) for k, v in (t.split(":", 1) for t in text.split(",") if t.strip())}
    if bad := [k for k, v in out.items() if not 1 <= v <= 255]:
        raise ValueError(f"class ids must be from 1 to 255: {bad}")
    return out


def class_filter(rows: DataFrame, classes: str) -> DataFrame:
    """The rows whose class is in the list; an empty list keeps all."""
    wanted = int_set(classes)
    return rows.where(F.col("cls").isin(*wanted)) if wanted else rows


def best_instances(instances: DataFrame) -> DataFrame:
    """Each scene's instance of greatest confidence, the first on ties; a filter before masks are made."""
    w = Window.partitionBy("unique_scene").orderBy(F.desc("conf"), "det_idx")
    return instances.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def select_instances(instances: DataFrame, masks: DataFrame, mode: str = "best") -> DataFrame:
    """(unique_scene, row_idx, col_idx, score, n_used): the mask of each scene's instance of greatest confidence, the first on ties (best), or
    the union of all its instances' masks, with the greatest confidence and their number (merge)."""
    if mode == "best":
        top = best_instances(instances).select("unique_scene", "det_idx", F.col("conf").alias("score"), F.lit(1).cast("bigint").alias("n_used"))
        return masks.join(top, ["unique_scene", "det_idx"]).select("unique_scene", "row_idx", "col_idx", "score", "n_used")
    stats = instances.groupBy("unique_scene").agg(F.max("conf").alias("score"), F.count("*").alias("n_used"))
    return masks.select("unique_scene", "row_idx", "col_idx").distinct().join(stats, "unique_scene")


def class_masks(instances: DataFrame, masks: DataFrame, least_conf: float, classes: str = "") -> DataFrame:
    """(unique_scene, cls, row_idx, col_idx): the union of each class's masks over the instances of that confidence or more."""
    kept = class_filter(instances.where(F.col("conf") >= least_conf), classes)
    return masks.join(kept.select("unique_scene", "det_idx", "cls"), ["unique_scene", "det_idx"]).select("unique_scene", "cls", "row_idx", "col_idx").distinct()


def mask_points(masks: DataFrame, px: DataFrame) -> DataFrame:
    """(unique_scene, row_idx, col_idx, x, y, z, classes): the finite points of mask pixels, each once, with the sorted classes that hold it."""
    held = masks.groupBy("unique_scene", "row_idx", "col_idx").agg(F.array_sort(F.collect_set("cls")).alias("classes"))
    finite = reduce(lambda a, b: a & b, (F.abs(k) < float("inf") for k in "xyz"))
    return px.where(finite).select("unique_scene", "row_idx", "col_idx", "x", "y", "z").join(held, ["unique_scene", "row_idx", "col_idx"])


def select_field(px: DataFrame, fields: list[str], fallback: str) -> Column:
    """The first of the fields that the pixels have, else the fallback."""
    return F.col(next((f for f in fields if f in px.columns), fallback))


def field_combos(px: DataFrame, fields: list[str]) -> DataFrame:
    """Each pixel once for every ordered triple of fields: combo, red, green, blue."""
    triples = [(a, b, c) for a in fields for b in fields for c in fields]
    rows = F.array(*(F.struct(F.lit("-".join(t)).alias("combo"), *(F.col(f).alias(n) for f, n in zip(t, ("red", "green", "blue"), strict=True))) for t in triples))
    return px.select("unique_scene", "row_idx", "col_idx", F.explode(rows).alias("k")).select("unique_scene", "row_idx", "col_idx", "k.*")


def dataset_manifest(files: DataFrame, names: list[str], targets: dict[str, float]) -> DataFrame:
    """One row (manifest) of JSON: class names, target shares, and per split the numbers of scenes and of recordings."""
    counts = files.groupBy("split").agg(F.count_distinct("unique_scene").alias("n_scenes"), F.count_distinct("bag_stem").alias("n_bags"))
    split = F.array_sort(F.collect_list(F.struct("split", "n_scenes", "n_bags")))
    shares = F.struct(*(F.lit(v).alias(k) for k, v in targets.items()))
    return counts.agg(F.to_json(F.struct(F.array(*map(F.lit, names)).alias("names"), shares.alias("targets"), split.alias("splits"))).alias("manifest"))
