"""Acquisition metadata: the line grammar, checks, channels, display settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.functions.numeric import half_even
from voxloom.functions.text import cleaned, key_of, rest_of, value_of

#: Metadata key -> column.
KEYS = {
    "laser": "channel", "intensity": "intensity", "zoom": "zoom", "filter": "filter", "shutter": "shutter",
    "pixelsize": "pixelsize", "z_stepsize": "z_scale", "x_pos": "x_pos", "y_pos": "y_pos",
    "x_pixels": "x_n_pixels", "y_pixels": "y_n_pixels", "z_planes": "z_n_pixels",
}
REQUIRED = ["channel", "filter", "x_scale", "y_scale", "z_scale", "x_pos", "y_pos", "x_n_pixels", "y_n_pixels", "z_n_pixels"]


def parsed_lines(lines: DataFrame) -> DataFrame:
    """(path, line_no, block, key, value) of metadata lines (path, line_no, line); a block starts at each `[Metadata for file]`. A file is one small group."""
    c = cleaned(F.col("line"))
    t = lines.select("path", "line_no", c.alias("c")).where(F.col("c") != "").select("path", "line_no", key_of(F.col("c")).alias("key"), F.when(key_of(F.col("c")) == "filter", rest_of(F.col("c"))).otherwise(value_of(F.col("c"))).alias("value"))
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("block", F.sum((F.col("key") == "metadata").cast("int")).over(w) - 1)
    return t.where(F.col("key").isin(list(KEYS))).select("path", "line_no", "block", "key", "value")


def acquisition_table(lines: DataFrame, with_path: bool = False) -> DataFrame:
    """One typed row per block, numbered over all files in order; null where a key is missing, the last value where it is repeated."""
    p = parsed_lines(lines).groupBy("path", "block").pivot("key", list(KEYS)).agg(F.max_by("value", "line_no"))
    for k, name in KEYS.items():
        if k != name:
            p = p.withColumnRenamed(k, name)
    number = lambda c: F.col(c).cast("double")
    t = p.select(
        *(["path"] if with_path else []), (F.row_number().over(Window.orderBy("path", "block")) - 1).alias("row"), "channel", number("intensity").alias("intensity"),
        F.substring_index("zoom", "_", 1).alias("zoom"), "filter", "shutter", number("pixelsize").alias("x_scale"), number("pixelsize").alias("y_scale"), number("z_scale").alias("z_scale"),
        number("x_pos").alias("x_pos"), number("y_pos").alias("y_pos"), *[F.col(c).cast("int").alias(c) for c in ("x_n_pixels", "y_n_pixels", "z_n_pixels")],
    )
    first = F.first("intensity").over(Window.orderBy("row").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return t.withColumn("intensity", F.when(first > 1, F.col("intensity") / 100).otherwise(F.col("intensity")))


def missing(table: DataFrame, columns: list[str] | None = None) -> dict[str, int]:
    """Required columns with nulls, and how many; one aggregate over the table."""
    columns = columns or REQUIRED
    r = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return {c: r[c] for c in columns if r[c]}


def require(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """table, or a ValueError that names the columns with missing values."""
    if bad := missing(table, columns):
        raise ValueError(f"metadata is missing: {', '.join(f'{c} in {n} rows' for c, n in bad.items())}")
    return table


def flagged(table: DataFrame, excluded: dict[str, list[int]]) -> DataFrame:
    """table with boolean `ignore`: true for the given 0-based places of each channel."""
    n = F.row_number().over(Window.partitionBy("channel").orderBy("row")) - 1
    hit = F.lit(False)
    for ch, at in excluded.items():
        if at:
            hit = hit | ((F.col("channel") == ch) & F.col("k_").isin(at))
    return table.withColumn("k_", n).withColumn("ignore", hit).drop("k_")


def checked_pixels(table: DataFrame) -> DataFrame:
    """x and y pixel counts swapped where a single row or column of tiles shows, or where tiles of the first row's size do not meet and swapping mends that.

    The first step between positions counts, in whole pixels. Where the counts
    are swapped, all rows get the first row's.
    """
    first = table.agg(*[F.min_by(c, "row").alias(n) for c, n in (("x_n_pixels", "px"), ("y_n_pixels", "py"), ("x_scale", "sx"), ("y_scale", "sy"))], *[F.slice(F.array_sort(F.collect_set(f"{a}_pos")), 1, 2).alias(f"at_{a}") for a in "xy"])
    step = {a: half_even(F.abs(F.col(f"at_{a}")[1] - F.col(f"at_{a}")[0]) / F.col(f"s{a}")) for a in "xy"}
    lap = lambda a, b: F.col(f"p{b}") - step[a]
    apart, mended = (lap("x", "x") < 0) | (lap("y", "y") < 0), (lap("x", "y") >= 0) & (lap("y", "x") >= 0)
    one = (F.size("at_x") == 1) | (F.size("at_y") == 1)
    t = table.join(F.broadcast(first.select("px", "py", F.when(one, True).otherwise(apart & mended).alias("swap_"))), F.lit(True))  # one row
    x, y = (F.when(F.col("swap_"), F.col(f"p{b}")).otherwise(F.col(f"{a}_n_pixels")).alias(f"{a}_n_pixels") for a, b in ("xy", "yx"))
    return t.select(*[c for c in table.columns if c not in ("x_n_pixels", "y_n_pixels")], x, y)


def with_channel_settings(table: DataFrame, settings: DataFrame) -> DataFrame:
    """table with label and color of each channel; a channel without a setting is an error. settings (wavelength, label, color) is a small dimension."""
    j = table.join(F.broadcast(settings), table["channel"] == settings["wavelength"], "left").drop("wavelength")
    bad = F.raise_error(F.concat(F.lit("no setting for channel "), F.col("channel")))
    return j.withColumn("label", F.when(F.col("label").isNull(), bad).otherwise(F.col("label")))


def display_channels(table: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """(image, channels): channels as an array of (active, label, wavelength_id, color, index, window) in order of first appearance; limits (index, start, end)."""
    w = Window.orderBy("first_row")
    c = table.groupBy("image", "channel", "label", "color").agg(F.min("row").alias("first_row"))
    c = c.withColumn("index", F.row_number().over(w.partitionBy("image")) - 1)
    if limits is not None:
        c = c.join(F.broadcast(limits), "index", "left")
    start, end = (F.coalesce("start", F.lit(0)), F.coalesce("end", F.lit(65535))) if limits is not None else (F.lit(0), F.lit(65535))
    window = F.struct(F.lit(0).alias("min"), F.least(end * 10, F.lit(65535)).alias("max"), start.alias("start"), end.alias("end"))
    one = F.struct(F.col("index"), F.lit(True).alias("active"), F.col("label"), F.col("channel").alias("wavelength_id"), F.col("color"), window.alias("window"))
    return c.groupBy("image").agg(F.array_sort(F.collect_list(one)).alias("channels"))


def updated_windows(meta: DataFrame, limits: dict[int, tuple[int, int]]) -> DataFrame:
    """meta with the display windows of the given channels replaced; everything else stays."""
    m = F.create_map(*[F.lit(x) for k, (s, e) in limits.items() for x in (k, f"{s},{e}")]) if limits else None
    if m is None:
        return meta

    def one(ch: Column) -> Column:
        v = F.split(F.try_element_at(m, ch["index"]), ",")
        start, end = v[0].cast("int"), v[1].cast("int")
        w = F.struct(F.lit(0).alias("min"), F.least(end * 10, F.lit(65535)).alias("max"), start.alias("start"), end.alias("end"))
        return F.when(v.isNull(), ch).otherwise(ch.withField("window", w))

    return meta.withColumn("channels", F.transform("channels", one))


def merged_channels(views: DataFrame) -> DataFrame:
    """(index, label, wavelength_id): channels of several sources (source, index, label, wavelength_id), one per label, in source order."""
    w = Window.orderBy("source", "index")
    one = views.groupBy("label").agg(F.min_by(F.struct("source", "index", "wavelength_id"), F.struct("source", "index")).alias("m"))
    one = one.select("label", "m.source", "m.index", "m.wavelength_id")
    return one.select((F.row_number().over(w) - 1).alias("index"), "label", "wavelength_id")


def channel_index(channels: DataFrame, wavelength: str | None = None, label: str | None = None) -> DataFrame:
    """Channels (index, label, wavelength_id) that match a wavelength, or whose label holds the text in any case."""
    if wavelength is not None:
        return channels.where(F.col("wavelength_id") == wavelength)
    return channels.where(F.lower("label").contains((label or "").lower()))


def jobs_by_channel(channels: DataFrame) -> DataFrame:
    """(position, channel, index) of an array column `channels` (index may be null: then its position)."""
    p = channels.select("image", F.posexplode("channels").alias("position", "ch"))
    return p.select("image", "position", F.col("ch.label").alias("label"), F.coalesce("ch.index", "position").alias("index"))


def with_provenance(meta: DataFrame, task: str, parameters: dict[str, str], version: str) -> DataFrame:
    """meta with an entry for the task appended to its map column `tasks`."""
    e = F.create_map(F.lit(task), F.struct(F.lit(version).alias("version"), F.create_map(*[F.lit(x) for kv in parameters.items() for x in kv]).alias("parameters") if parameters else F.create_map().cast("map<string,string>").alias("parameters")))
    return meta.withColumn("tasks", F.map_concat(F.map_filter("tasks", lambda k, _: k != task), e) if "tasks" in meta.columns else e)
