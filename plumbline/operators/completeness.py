"""Completeness: which expected elements have a value, and the roll-ups of that."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.measures import percent
from plumbline.functions.joins import key_join
from plumbline.functions.marks import element_marks
from plumbline.functions.text import has_value, strip
from plumbline.sources.local import text_frame


def _filled(export: DataFrame, marks: DataFrame, words: int) -> DataFrame:
    """One row per exported patient and episode, with the marks of the elements that have a value there.

    Marks are numbers that combine before the shuffle, so that meets a row per episode, not one per element.
    """
    rows = export.select(
        "PID", F.col("Episode_Date").alias("_episode"), "source_id", has_value(F.col("source_value")).alias("_has"),
    ).join(F.broadcast(marks), "source_id", "left")
    set_in = lambda w: F.bit_or(F.when(F.col("_has") & (F.col("_word") == w), F.col("_bit")))
    return rows.groupBy("PID", "_episode").agg(*[F.coalesce(set_in(w), F.lit(0)).alias(f"_bits{w}") for w in range(words)])


def _with_marks(expected: DataFrame, export: DataFrame, marks: DataFrame, words: int) -> DataFrame:
    """Rows of exported patients with ``_marks``: of any episode, for basic forms, and of their own, for others.

    Both joins are of large tables. Parquet holds such tables in a small part of their size in memory, by which Spark
    would broadcast millions of rows, so they are told to merge.
    Rows without a patient have been dropped, so both are null-safe on it, which keeps filters from the export's plan: both
    joins have the same shuffle of it, which Spark makes once and reuses.
    """
    names = [f"_bits{w}" for w in range(words)]
    per_episode = _filled(export, marks, words)
    per_patient = per_episode.groupBy("PID").agg(*[F.bit_or(c).alias(f"_any{c}") for c in names])
    rows = expected.filter("form_type in ('basic', 'longitudinal') and PID is not null")
    rows = key_join(rows, per_patient.hint("merge"), ["PID"], null_safe=("PID",)).withColumn("_episode", _own_episode())
    joined = key_join(rows, per_episode.hint("merge"), ["PID", "_episode"], "left", null_safe=("PID", "_episode"))
    return joined.select(*expected.columns, F.array(*[
        F.when(F.col("form_type") == "basic", F.col(f"_any{c}")).otherwise(F.col(c)) for c in names]).alias("_marks"))


def _is_marked() -> Column:
    return F.coalesce(F.get("_marks", F.col("_word")).bitwiseAND(F.col("_bit")) != 0, F.lit(False))


def completeness_rows(expected: DataFrame, export: DataFrame) -> DataFrame:
    """Expected elements of exported patients with ``is_filled``."""
    marks, words = element_marks(expected)
    return _with_marks(expected, export, marks, words).join(F.broadcast(marks), "source_id", "left").select(
        *expected.columns, _is_marked().alias("is_filled"))


def _marked_versions(versions: DataFrame, elements: DataFrame, export: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Form versions of exported patients with their marks, and the elements of forms with the places of theirs."""
    marks, words = element_marks(elements)
    return _with_marks(versions, export, marks, words), elements.join(F.broadcast(marks), "source_id", "left")


def _expanded(versions: DataFrame, placed: DataFrame, core_elements: DataFrame) -> DataFrame:
    """C1-C6 from marked versions: a row per element, as :func:`completeness_rows` has them of expected elements."""
    on = ["form_id", "form_version"]
    return versions.join(F.broadcast(add_core_flag(placed, core_elements)), on, "left").withColumns({
        "is_filled": _is_marked(), "is_core": F.coalesce("is_core", F.lit(False))}).drop("_marks", "_word", "_bit")


def _base_urn(urn: Column) -> Column:
    return F.regexp_replace(urn, r":[0-9]+$", "")


def add_core_flag(rows: DataFrame, core_elements: DataFrame) -> DataFrame:
    """``is_core`` by form and element, whatever the element's version."""
    core = core_elements.select(
        "form_id", _base_urn(F.col("dataelement_urn")).alias("dataelement_base_urn"),
        F.lit(True).alias("is_core")).distinct()
    rows = rows.withColumn("dataelement_base_urn", _base_urn(F.col("dataelement_urn")))
    return rows.join(core, ["form_id", "dataelement_base_urn"], "left").withColumn(
        "is_core", F.coalesce("is_core", F.lit(False)))


def _own_episode() -> Column:
    """The episode of a form: none for basic forms."""
    return F.when(F.col("form_type") == "longitudinal", F.col("episode_date"))


def _any_in_form(any_value: str, spread: Column | None = None, episode: Column | None = None) -> Column:
    """Whether any row of the same form (of that patient and episode) is set; null where its key is incomplete.

    Such a window holds a form's elements, or its versions. Rows whose key is incomplete would share windows with others
    of their kind and are spread over them by ``spread`` instead. ``episode``: the form's own, where rows have it.
    """
    known = F.col("PID").isNotNull() & F.col("form_id").isNotNull() & (
        (F.col("form_type") == "basic") | F.col("episode_date").isNotNull())
    keys = [F.col("form_type"), F.col("PID"), _own_episode() if episode is None else episode, F.col("form_id")]
    apart = [] if spread is None else [F.when(~known, spread)]
    return F.when(known, F.max(any_value).over(Window.partitionBy(*keys, *apart)))


def add_presence_flag(rows: DataFrame) -> DataFrame:
    """Whether the patient's form (of that episode) has any value; null where its key is incomplete."""
    return rows.withColumn("form_has_any_value", _any_in_form("is_filled", F.col("source_id")))


def flagged_rows(expected: DataFrame, export: DataFrame, core_elements: DataFrame) -> DataFrame:
    """The table every roll-up starts from."""
    return add_presence_flag(add_core_flag(completeness_rows(expected, export), core_elements))


def flagged_versions(versions: DataFrame, elements: DataFrame, export: DataFrame, core_elements: DataFrame) -> DataFrame:
    """C1-C7 from form versions and the elements of forms: as :func:`flagged_rows` of the expected elements, but versions
    meet the export and each other before they become a row per element."""
    marked, placed = _marked_versions(versions, elements, export)
    ids = placed.groupBy("form_id", "form_version").agg(
        F.collect_set(F.when(F.col("_bit").isNotNull(), F.struct("_word", "_bit"))).alias("_own"))
    any_value = F.coalesce(F.exists("_own", lambda e: F.get("_marks", e["_word"]).bitwiseAND(e["_bit"]) != 0), F.lit(False))
    flagged = marked.join(F.broadcast(ids), ["form_id", "form_version"], "left").withColumn("_any", any_value).withColumn(
        "form_has_any_value", _any_in_form("_any")).drop("_own", "_any")
    return _expanded(flagged, placed, core_elements)


def present_forms(rows: DataFrame) -> DataFrame:
    """C8."""
    return rows.filter("form_has_any_value")


_SUMS = ("n", "n_filled", "c", "c_filled", "m", "m_filled", "n_expected_elements", "n_core_elements")
INSTANCE_KEYS = ["form_type", "PID", "episode_date", "form_id", "form_version"]


def form_instances(rows: DataFrame) -> DataFrame:
    """Partial sums per patient, episode (longitudinal only), form and version; every roll-up is a sum of these.

    ``version_has_any_value`` belongs to the instance, ``form_has_any_value`` (C7) to the form in any version. Without a
    form label the result has none. Instances are returned as they are.
    """
    if "version_has_any_value" in rows.columns:
        return rows
    filled, core = F.col("is_filled"), F.coalesce("is_core", F.lit(False)) if "is_core" in rows.columns else F.lit(False)
    mandatory = _is_mandatory(rows)
    sums = (F.count("*"), F.count_if(filled), F.count_if(core), F.count_if(core & filled), F.count_if(mandatory),
            F.count_if(mandatory & filled), F.count("source_id"), F.count(F.when(core, F.col("source_id"))))
    labels = [_first_label(rows).alias("_label")] if "form_label" in rows.columns else []
    found = rows.groupBy(*[_own_episode().alias(k) if k == "episode_date" else k for k in INSTANCE_KEYS]).agg(
        F.max("is_filled").alias("version_has_any_value"), *[s.alias(n) for s, n in zip(sums, _SUMS)], *labels)
    return found.withColumn("form_has_any_value", _any_in_form("version_has_any_value"))


def _is_mandatory(rows: DataFrame) -> Column:
    if "mandatory" not in rows.columns:
        return F.lit(False)
    return F.coalesce(F.lower(strip(F.col("mandatory"))).isin(list(fixed.MANDATORY_TEXTS)), F.lit(False))


def _first_label(rows: DataFrame) -> Column:
    """First label in file order, with its place, or the smallest where no order is recorded: the least of leasts."""
    place = F.col("row_ord") if "row_ord" in rows.columns else F.lit(None).cast("bigint")
    return F.min(F.when(F.col("form_label").isNotNull(), F.struct(place.alias("at"), F.col("form_label").alias("text"))))


#: The levels of the roll-ups and their keys.
LEVELS = {"all": [], "type": ["form_type"], "patient": ["PID"], "form": ["form_id"],
          "version": ["form_id", "form_version"]}


def roll_up(present: DataFrame, levels=tuple(LEVELS)) -> DataFrame:
    """C9, C11-C13 as one aggregate: the sums of present forms at every level asked for, named in ``level``.

    Patients are counted without distinct: the first row of each patient's form, and of each patient's form version, is
    marked among the few versions of a form, and marks are summed like everything else.
    """
    instances = form_instances(present)
    keys = ["form_type", "PID", "form_id", "form_version"]
    labelled = ["_label"] if "_label" in instances.columns else []
    sums = instances.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS], *[F.min(c).alias(c) for c in labelled])
    marks = []
    if {"form", "version"} & set(levels):
        marks = ["_of_form", "_of_version"]
        in_form = Window.partitionBy("PID", "form_id").orderBy("form_version", "form_type")
        in_version = Window.partitionBy("PID", "form_id", "form_version").orderBy("form_type")
        sums = sums.withColumns({
            m: (F.col("PID").isNotNull() & (F.row_number().over(w) == 1)).cast("int")
            for m, w in zip(marks, (in_form, in_version))})
    sets = [[F.col(k) for k in LEVELS[level]] for level in levels]
    on = lambda k: F.grouping(k) == 0
    name = F.when(on("form_type"), "type").when(on("PID"), "patient").when(on("form_version"), "version").when(
        on("form_id"), "form").otherwise("all")
    found = sums.groupingSets(sets, *keys).agg(
        name.alias("level"), *[F.sum(c).alias(c) for c in (*_SUMS, *marks)], *[F.min(c).alias(c) for c in labelled])
    return found.withColumns({
        "general_expected_n": F.col("n_expected_elements"), "general_filled_n": F.col("n_filled"),
        "core_expected_n": F.col("n_core_elements"), "core_filled_n": F.col("c_filled"),
        "general_completeness_percent": percent(F.col("n_filled"), F.col("n_expected_elements")),
        "core_completeness_percent": percent(F.col("c_filled"), F.col("n_core_elements")),
    })


def _at(present: DataFrame, *levels: str) -> DataFrame:
    """Rows of some levels, from a roll-up that has them or from rows or instances."""
    rolled = present if "level" in present.columns else roll_up(present, levels)
    return rolled.filter(F.col("level").isin(list(levels)))


def completeness_summary(present: DataFrame) -> DataFrame:
    """General, core and mandatory percentages, over all rows and per form type."""
    tiers = _at(present, "all", "type").withColumn("tier", F.coalesce(F.when(F.col("level") == "type", F.col("form_type")),
                                                                      F.col("level")))
    names = text_frame(present.sparkSession, fixed.COMPLETENESS_METRICS, ("tier", "metric"))
    return names.join(tiers, "tier", "left").select(
        "metric",
        percent(F.col("n_filled"), F.col("n")).alias("general_completeness_percent"),
        percent(F.col("c_filled"), F.col("c")).alias("core_completeness_percent"),
        percent(F.col("m_filled"), F.col("m")).alias("mandatory_completeness_percent"),
    )


def form_presence_summary(rows: DataFrame) -> DataFrame:
    """C10, on all rows, present forms or not."""
    of_type = lambda t: F.col("form_type") == t
    empty = ~F.col("version_has_any_value")
    counts = form_instances(rows).agg(
        F.array(*[
            F.struct(F.lit(name).alias("metric"), denominator.alias("denominator_n"), numerator.alias("numerator_n"))
            for name, denominator, numerator in zip(
                fixed.PRESENCE_METRICS,
                (F.count("*"), F.count_if(of_type("basic")), F.count_if(of_type("longitudinal"))),
                (F.count_if("version_has_any_value"), F.count_if(of_type("basic") & empty),
                 F.count_if(of_type("longitudinal") & empty)),
            )
        ]).alias("metrics")
    )
    return counts.select(F.inline("metrics")).select(
        "*", percent(F.col("numerator_n"), F.col("denominator_n")).alias("percent"))


_LEVEL_COLUMNS = ("general_expected_n", "general_filled_n", "general_completeness_percent",
                  "core_expected_n", "core_filled_n", "core_completeness_percent")


def completeness_per_patient(present: DataFrame) -> DataFrame:
    """C11."""
    return _at(present, "patient").select("PID", *_LEVEL_COLUMNS).orderBy("general_completeness_percent", "PID")


def completeness_per_form(present: DataFrame) -> DataFrame:
    """C12."""
    return _at(present, "form").select(
        "form_id", F.col("_label.text").alias("form_label"), *_LEVEL_COLUMNS, F.col("_of_form").alias("n_patients"),
    ).orderBy("general_completeness_percent", "form_id")


def completeness_per_form_version(present: DataFrame) -> DataFrame:
    """C13."""
    return _at(present, "version").select(
        "form_id", "form_version", *_LEVEL_COLUMNS, F.col("_of_version").alias("n_patients"),
    ).orderBy("general_completeness_percent", "form_id", "form_version")


def completeness_per_element(present: DataFrame) -> DataFrame:
    """C14: per element, which instances do not know, so from the rows."""
    core, filled, labelled = F.col("is_core"), F.col("is_filled"), "element_label" in present.columns
    label = F.min("element_label")
    if "row_ord" in present.columns:
        label = F.min_by("element_label", F.when(F.col("element_label").isNotNull(), F.col("row_ord")))
    counts = present.groupBy("source_id").agg(
        F.count("PID").alias("general_expected_n"), F.count_if(filled).alias("general_filled_n"),
        F.count(F.when(core, F.col("PID"))).alias("core_expected_n"), F.count_if(core & filled).alias("core_filled_n"),
        *([label.alias("element_label")] if labelled else []))
    return counts.withColumns({
        "general_completeness_percent": percent(F.col("general_filled_n"), F.col("general_expected_n")),
        "core_completeness_percent": percent(F.col("core_filled_n"), F.col("core_expected_n")),
    }).select("source_id", *(["element_label"] if labelled else []), *_LEVEL_COLUMNS).orderBy(
        F.asc("general_completeness_percent"), F.desc("general_expected_n"), "source_id")


def empty_forms(rows: DataFrame, form_type: str) -> DataFrame:
    """Expected forms without any value, on all rows."""
    episode = ["episode_date"] if form_type == "longitudinal" else []
    return form_instances(rows).filter((F.col("form_type") == form_type) & ~F.col("version_has_any_value")).select(
        "PID", *episode, "form_id", "form_version", F.col("version_has_any_value").alias("form_has_any_value"),
        "n_expected_elements", F.col("n_filled").alias("n_filled_elements"))


def _form_sums(placed: DataFrame, words: int) -> tuple[DataFrame, int]:
    """What each form version adds to the sums of a form instance: counts of its elements, and their marks by kind. As long
    as the elements of the forms. An element that stands in a form more than once has its marks in as many layers, so
    that no mark stands for two rows; the number of layers comes with the table."""
    form = ["form_id", "form_version"]
    core, mandatory = F.col("is_core"), _is_mandatory(placed)
    rows = placed.withColumns({"_mandatory": mandatory, "_layer": F.row_number().over(
        Window.partitionBy(*form, "source_id").orderBy(F.desc("is_core"), F.desc(mandatory)))})
    layers = rows.filter("source_id is not null").agg(F.coalesce(F.max("_layer"), F.lit(1))).first()[0]
    marked = lambda flag, at: F.bit_or(F.when(flag & (F.col("_layer") == at[0]) & (F.col("_word") == at[1]), F.col("_bit")))
    flags = {"n_filled": F.lit(True), "c_filled": core, "m_filled": F.col("_mandatory")}
    counts = {"n": F.count("*"), "c": F.count_if(core), "m": F.count_if("_mandatory"),
              "n_expected_elements": F.count("source_id"), "n_core_elements": F.count(F.when(core, F.col("source_id")))}
    labels = [_first_label(rows).alias("_label")] if "form_label" in rows.columns else []
    return rows.groupBy(*form).agg(
        *[c.alias(name) for name, c in counts.items()], *labels,
        *[F.coalesce(marked(flag, (k + 1, w)), F.lit(0)).alias(f"_{name}_{k}_{w}")
          for name, flag in flags.items() for k in range(layers) for w in range(words)]), layers


def instances(versions: DataFrame, elements: DataFrame, export: DataFrame, core_elements: DataFrame) -> DataFrame:
    """C1-C7 reduced to form instances: the table that all roll-ups but the one per element start from.

    As :func:`form_instances` of a row per element, but the elements of a version are counted by their marks. Versions are
    dealt by form, of which instances and forms in any version are groups, so they are shuffled and sorted once for both.
    """
    marks, words = element_marks(elements)
    placed = add_core_flag(elements.join(F.broadcast(marks), "source_id", "left"), core_elements)
    sums, layers = _form_sums(placed, words)
    known = _with_marks(versions, export, marks, words).join(F.broadcast(sums), ["form_id", "form_version"], "left")
    # A version without elements is a row without an element.
    counted = {c: F.coalesce(c, F.lit(int(c == "n"))) for c in _SUMS if not c.endswith("filled")}
    filled = {c: reduce(Column.__add__, [
        F.coalesce(F.bit_count(F.get("_marks", F.lit(w)).bitwiseAND(F.col(f"_{c}_{k}_{w}"))), F.lit(0)).cast("bigint")
        for k in range(layers) for w in range(words)]) for c in _SUMS if c.endswith("filled")}
    labels = ["_label"] if "_label" in sums.columns else []
    rows = known.withColumns({**counted, **filled, "episode_date": _own_episode()}).select(*INSTANCE_KEYS, *_SUMS, *labels)
    dealt = rows.repartition("form_type", "PID", "episode_date", "form_id")
    # Nearly every version is an instance of its own, of which a hash table would hold all. Windows need the one sort that
    # the forms' window below needs too.
    first = Window.partitionBy(*INSTANCE_KEYS).orderBy("form_version")
    every = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = dealt.withColumns({
        "version_has_any_value": F.max(F.col("n_filled") > 0).over(every), **{c: F.sum(c).over(every) for c in _SUMS},
        **{c: F.min(c).over(every) for c in labels}, "_nth": F.row_number().over(first)}).filter("_nth = 1").drop("_nth")
    return found.withColumn("form_has_any_value", _any_in_form("version_has_any_value", episode=F.col("episode_date")))
