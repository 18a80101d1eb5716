"""Run events: gate, rejects, long form, named datasets, and pairs of inputs and outputs.

Events come nested (one row holds the whole document) or long (one row per dataset reference).
Nested events are paired inside their row, after one exchange that deals the rows out. Long events are collapsed per
(event, side, name) first and paired by an equi-join that copes with hot events; a pair that
occurs several times is one row with its number of occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.names import dataset_name, has_dataset_name, known_name
from tributary.operators.once import built_once, let
from tributary.operators.skew import grid_cells, on_grid

KEPT_TYPES = ("COMPLETE", "START")
CELL = 2000  # datasets of a side in one cell of a large event: four million pairs


def kept_type() -> Column:
    return F.col("event_type").isin(*KEPT_TYPES)


def passes_gate() -> Column:
    """For nested events: the right type, and something on both sides."""
    return kept_type() & (F.size("inputs") > 0) & (F.size("outputs") > 0)


def _has_name(dataset: Column) -> Column:
    return has_dataset_name(dataset["namespace"], dataset["name"], dataset["symlinks"])


def _broken_symlink(dataset: Column) -> Column:
    links = dataset["symlinks"]
    return (F.size(links) > 0) & F.get(links, F.lit(0))["namespace"].isNull()


def reject_reason() -> Column:
    """Why a nested event cannot be handled, or not to its end; null if it can.

    Outputs are only looked at once an input has a name, so a broken output symlink does no harm
    in an event without named inputs. What was sent before a broken symlink stays sent: see
    ``dataset_pairs``.
    """
    broken = F.exists("inputs", _broken_symlink) | (
        F.exists("outputs", _broken_symlink) & F.exists("inputs", _has_name)
    )
    return (
        F.when(F.col("event_id").isNull(), "null_event_id")
        .when(F.col("event_type").isNull(), "null_type")
        .when(F.col("inputs").isNull(), "null_inputs")
        .when(F.col("outputs").isNull(), "null_outputs")
        .when(passes_gate() & broken, "null_symlink_namespace")
    )


def rejected_events(events: DataFrame) -> DataFrame:
    return events.withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())


def accepted_events(events: DataFrame) -> DataFrame:
    """Events that are handled to their end."""
    return events.where(reject_reason().isNull() & F.coalesce(passes_gate(), F.lit(False)))


def sent_events(events: DataFrame) -> DataFrame:
    """Events that edges may come from: those accepted, and those handled up to a broken symlink."""
    return events.where(F.col("event_id").isNotNull() & F.coalesce(passes_gate(), F.lit(False)))


def sent_refs(refs: DataFrame) -> DataFrame:
    """The references of the long form that are reached before a broken symlink, by the rule of
    ``dataset_pairs``. Only events with a broken one are looked at; for data without any this is a scan."""
    link = F.get("symlinks", F.lit(0))
    broken = (F.size("symlinks") > 0) & link["namespace"].isNull()
    named_input = (F.col("side") == "input") & has_dataset_name(F.col("namespace"), F.col("name"), F.col("symlinks"))
    first = lambda test: F.min(F.when(test, F.col("pos")))
    faulty = refs.where(broken).groupBy("event_id").agg(
        first(F.col("side") == "input").alias("_bad_in"), first(F.col("side") == "output").alias("_bad_out")
    )
    leading = refs.where(named_input & ~F.coalesce(broken, F.lit(False))).join(faulty, "event_id").where(
        F.col("_bad_in").isNull() | (F.col("pos") < F.col("_bad_in"))
    ).groupBy("event_id").agg(F.min("pos").alias("_first_in"))
    limits = faulty.join(leading, "event_id", "left")
    is_input = F.col("side") == "input"
    reached = F.when(
        is_input,
        (F.col("_bad_in").isNull() | (F.col("pos") < F.col("_bad_in")))
        & (F.col("_bad_out").isNull() | (F.col("pos") == F.col("_first_in"))),
    ).otherwise(F.col("_bad_out").isNull() | (F.col("pos") < F.col("_bad_out")))
    checked = refs.join(limits, "event_id", "left")
    known = F.col("_bad_in").isNotNull() | F.col("_bad_out").isNotNull()
    return checked.where(~known | F.coalesce(reached, F.lit(False))).select(*refs.columns)


def gate_long(events: DataFrame, refs: DataFrame) -> DataFrame:
    """The gate over the long form: both sides are checked in one aggregate, one row per event."""
    both = (
        refs.groupBy("event_id")
        .agg(
            F.max(F.col("side") == "input").alias("has_input"),
            F.max(F.col("side") == "output").alias("has_output"),
        )
        .where("has_input AND has_output")
    )
    return events.where(kept_type()).join(both, "event_id", "left_semi")


def to_long(events: DataFrame) -> DataFrame:
    """One row per dataset reference; an empty or missing list leaves one row without dataset."""
    sides = F.array(
        F.struct(F.lit("input").alias("side"), F.col("inputs").alias("datasets")),
        F.struct(F.lit("output").alias("side"), F.col("outputs").alias("datasets")),
    )
    return (
        events.select("event_id", "event_type", "event_time", "run_id", F.inline(sides))
        .select("*", F.posexplode_outer("datasets").alias("pos0", "dataset"))
        .select(
            "event_id", "event_type", "event_time", "run_id", "side",
            (F.col("pos0") + 1).cast("bigint").alias("pos"),
            "dataset.*",
        )
    )


def with_names(refs: DataFrame) -> DataFrame:
    return refs.withColumn("table_name", dataset_name(F.col("namespace"), F.col("name"), F.col("symlinks")))


def named(refs: DataFrame) -> DataFrame:
    dataset = [F.col("namespace"), F.col("name"), F.col("symlinks")]
    return refs.where(has_dataset_name(*dataset)).withColumn("table_name", known_name(*dataset))


def name_counts(refs: DataFrame, n: Column | None = None) -> DataFrame:
    """Each distinct name once, with its number of references (or the sum of ``n``)."""
    return refs.groupBy("table_name").agg((F.count(F.lit(1)) if n is None else F.sum(n)).alias("n"))


def distinct_names(counts: DataFrame) -> DataFrame:
    """The names of ``name_counts``. The test holds for all of them; it keeps the count in the plan, so
    that lookups and hot keys are read from one and the same exchange."""
    return counts.where(F.col("n") > 0).select("table_name")


def collapse(named_refs: DataFrame) -> DataFrame:
    """Each name once per event and side: its occurrences ``n`` and its last position.

    Both sides come out of one aggregate through a generator. Filters on the side stay above it, and
    the null test of later joins is made here, so everything that reads the result shares one scan and
    one exchange.
    """

    def side(name: str) -> tuple[Column, Column]:
        here = F.col("side") == name
        return F.count(F.when(here, 1)).alias(name), F.max(F.when(here, F.col("pos"))).alias(name + "_pos")

    def row(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("side"), F.col(name).alias("n"), F.col(name + "_pos").alias("pos")
        )

    return (
        named_refs.where(F.col("event_id").isNotNull())
        .groupBy("event_id", "table_name")
        .agg(*side("input"), *side("output"))
        .select("event_id", "table_name", F.inline(F.array(row("input"), row("output"))))
        .where(F.col("n") > 0)
    )


def pair_sides(events: DataFrame, sides: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Pair collapsed inputs with collapsed outputs of the same event.

    ``events`` brings its own columns, one row per event. Columns of ``sides`` come back as ``in_*``
    and ``out_*``, the number of occurrences of the pair as ``n_pairs``. Where ``sides`` has been
    joined to more, ``counted`` is the collapsed frame before that, to find large events in. Their
    product is cut into the cells of a grid: inputs by row, outputs by column, ``CELL`` of each at most.
    """
    payload = [c for c in sides.columns if c not in ("event_id", "side")]

    def side(name: str, prefix: str) -> DataFrame:
        return sides.where(F.col("side") == name).select(
            "event_id", *[F.col(c).alias(prefix + c) for c in payload]
        )

    key = ["event_id"]
    size = lambda name: F.count(F.when(F.col("side") == name, 1)).alias(name)
    counts = (sides if counted is None else counted).groupBy(*key).agg(size("input"), size("output"))
    grid = grid_cells(counts, key, "input", "output", CELL)
    inputs = on_grid(side("input", "in_"), grid, key, ["in_table_name"], "_rows")
    outputs = on_grid(side("output", "out_"), grid, key, ["out_table_name"], "_cols")
    on = [*key, "_row", "_col"]
    return (
        inputs.join(on_grid(events, grid, key, key, None), on)
        .join(outputs, on)
        .withColumn("n_pairs", F.col("in_n") * F.col("out_n"))
        .drop("_row", "_col", "in_n", "out_n")
    )


FIELDS = "array<struct<from_column:string,to_column:string>>"


def _facet_links(facet: Column) -> Column:
    """Column facet as a map: the fields (from_column, to_column) by the name of the input they draw on."""
    flat = F.flatten(
        F.transform(
            F.map_entries(facet),
            lambda entry: F.transform(
                entry["value"],
                lambda field: F.struct(
                    field["name"].alias("in_name"), field["field"].alias("from_column"), entry["key"].alias("to_column")
                ),
            ),
        )
    )

    def by_input(fields: Column) -> Column:
        names = F.array_distinct(F.filter(fields["in_name"], lambda name: name.isNotNull()))
        of = lambda name: F.transform(
            F.filter(fields, lambda f: f["in_name"] == name),
            lambda f: F.struct(f["from_column"].alias("from_column"), f["to_column"].alias("to_column")),
        )
        return F.map_from_arrays(names, F.transform(names, of)).cast(f"map<string,{FIELDS}>")

    return F.when(F.size(facet) > 0, let(flat, by_input))


def _checked(datasets: str, *fields: tuple[str, Column]) -> Column:
    """(pos, name, broken, ...) of every dataset; a dataset without a name has none."""
    return F.transform(
        datasets,
        lambda d, i: F.struct(
            (i + 1).cast("bigint").alias("pos"),
            dataset_name(d["namespace"], d["name"], d["symlinks"]).alias("name"),
            F.coalesce(_broken_symlink(d), F.lit(False)).alias("broken"),
            *[of(d).alias(n) for n, of in fields],
        ),
    )


def _reached(datasets: str) -> Column:
    """The named datasets before the first broken one."""
    first = F.array_position(F.col(datasets)["broken"], True)
    return let(first, lambda end: F.filter(datasets, lambda d: d["name"].isNotNull() & ((end == 0) | (d["pos"] < end))))


def _cells(ins: str, outs: str, cell: int) -> Column:
    """The product of both sides as cells (row, column) of ``cell`` datasets a side; one cell if it is not
    larger than that."""
    parts = lambda side: F.when(
        F.size(ins).cast("bigint") * F.size(outs) > cell * cell, F.ceil(F.size(side) / cell)
    ).otherwise(1).cast("int")
    numbers = lambda side: F.sequence(F.lit(0), F.greatest(parts(side), F.lit(1)) - 1)
    return F.flatten(F.transform(
        numbers(ins), lambda i: F.transform(numbers(outs), lambda j: F.struct(i.alias("row"), j.alias("col")))
    ))


def named_sides(events: DataFrame, cell: int = CELL) -> DataFrame:
    """Nested events with the named datasets of both sides that are reached, as ``ins`` and ``outs``.

    Inputs are gone through in order, and for each all outputs. The first broken input ends the event. A
    broken output ends it during the first named input, which then has met the outputs before it; no later
    input is reached.

    Documents are read once and datasets named once; then one exchange deals the sides out, which all that
    follows reads: the names, and the pairs. An event whose product is above ``cell * cell`` comes as the
    cells of a grid, so several tasks make its pairs.
    """
    keep = ("event_id", "event_time", "run_id")
    found = built_once(
        sent_events(events),
        _checked("inputs", ("raw", lambda d: d["name"])).alias("inputs"),
        _checked("outputs", ("links", lambda d: _facet_links(d["column_lineage"]))).alias("outputs"),
        keep=keep,
    )
    bad_out = F.exists("outputs", lambda d: d["broken"])
    ins = let(_reached("inputs"), lambda reached: F.when(bad_out, F.slice(reached, 1, 1)).otherwise(reached))
    sides = built_once(
        found,
        F.transform(ins, lambda d: F.struct(d["pos"].alias("pos"), d["name"].alias("name"), d["raw"].alias("raw"))).alias("ins"),
        F.transform(_reached("outputs"), lambda d: F.struct(d["pos"].alias("pos"), d["name"].alias("name"), d["links"].alias("links"))).alias("outs"),
        keep=keep,
    ).where((F.size("ins") > 0) & (F.size("outs") > 0))
    cells = sides.select("*", F.explode(_cells("ins", "outs", cell)).alias("cell"))
    whole = F.size("ins").cast("bigint") * F.size("outs") <= cell * cell

    def part(side: str, number: Column) -> Column:
        return F.when(whole, F.col(side)).otherwise(F.slice(side, number * cell + 1, F.lit(cell)))

    cut = cells.select(*keep, part("ins", F.col("cell.row")).alias("ins"), part("outs", F.col("cell.col")).alias("outs"),
                       F.monotonically_increasing_id().alias("_at"))
    dealt = cut.repartition("_at")  # a number per row: no event, however often it was sent, is one task's
    return built_once(dealt, *[F.col(c).alias(c) for c in (*keep, "ins", "outs")])


def side_names(sides: DataFrame) -> DataFrame:
    """How often each name stands in a pair, counted over the sides: a dataset is in as many pairs as the
    other side has datasets."""
    weighed = F.concat(
        F.transform("ins", lambda x: F.struct(x["name"].alias("table_name"), F.size("outs").cast("bigint").alias("n"))),
        F.transform("outs", lambda x: F.struct(x["name"].alias("table_name"), F.size("ins").cast("bigint").alias("n"))),
    )
    return sides.select(F.inline(weighed)).where(F.col("n") > 0).groupBy("table_name").agg(F.sum("n").alias("n"))


def dataset_pairs(sides: DataFrame) -> DataFrame:
    """Pairs of the datasets of ``named_sides``, made inside the event's row.

    ``links`` holds the facet fields of the output that draw on this input: the input looks itself up by its
    own name. Outputs come apart first and leave only names behind, so their facets are not copied per pair.
    """
    keep = ["event_id", "event_time", "run_id"]
    targets = sides.select(*keep, "ins", F.explode("outs").alias("target"))
    drawn = F.try_element_at("target.links", F.col("source.raw"))
    return targets.select(*keep, "target", F.explode("ins").alias("source")).select(
        *keep,
        F.col("source.pos").alias("in_pos"),
        F.col("target.pos").alias("out_pos"),
        F.col("source.name").alias("from_name"),
        F.col("target.name").alias("to_name"),
        F.coalesce(drawn, F.array().cast(FIELDS)).alias("links"),
    )
