"""Relational conformance: ids and form versions that appear in one table but not in another.

Both sides of a comparison are stacked with a flag and reduced by key in one aggregate, which combines before
the shuffle and never sends a hot key's rows to one task.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.marks import element_marks
from plumbline.functions.text import has_value, strip_plain
from plumbline.operators.contract import make_summary, make_violation

VIOLATION_COLUMNS = (
    "PID", "Episode_Date", "source_id", "form_id", "form_version", "rule_id", "rule_type", "expected", "observed",
)
_EXPECTED = {rule_id: expected for rule_id, expected, _, _ in fixed.RELATIONAL_RULES}
SOURCE_ID, PID_MAPPING, ELEMENT, FORM_VERSION = [r[0] for r in fixed.RELATIONAL_RULES]


def clean(df: DataFrame, columns) -> DataFrame:
    """Trimmed texts, empty episode date as null, lower-case form type."""
    df = df.withColumnsRenamed({"episode_date": "Episode_Date"})
    out = df.withColumns({c: strip_plain(F.col(c)) for c in columns if c in df.columns})
    if "Episode_Date" in out.columns:
        out = out.withColumn("Episode_Date", F.nullif("Episode_Date", F.lit("")))
    return out.withColumn("form_type", F.lower("form_type")) if "form_type" in out.columns else out


def clean_export(export: DataFrame) -> DataFrame:
    return clean(export, ["PID", "Episode_Date", "source_id"])


def clean_expected(expected: DataFrame) -> DataFrame:
    return clean(expected, ["PID", "Episode_Date", "source_id", "form_id", "form_version", "form_type"])


def _both_sides(observed: DataFrame, valid: DataFrame, keys) -> DataFrame:
    """Distinct keys of both tables with ``in_observed`` and ``in_valid``; incomplete keys are left out."""
    side = lambda df, in_observed: df.select(
        *keys, F.lit(in_observed).alias("in_observed"), F.lit(not in_observed).alias("in_valid")
    ).dropna(subset=list(keys))
    return side(observed, True).unionByName(side(valid, False)).groupBy(*keys).agg(
        F.max("in_observed").alias("in_observed"), F.max("in_valid").alias("in_valid"))


def _violation(failed: DataFrame, rule_id: str, observed) -> DataFrame:
    return make_violation(failed, rule_id, fixed.RELATIONAL_RULE_TYPE, _EXPECTED[rule_id], observed,
                          VIOLATION_COLUMNS)


def source_id_units(export: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct exported ids; violated where the dictionary lacks the id."""
    return _both_sides(export, clean(dictionary, ["source_id"]), ["source_id"]).filter("in_observed").select(
        "source_id", (~F.col("in_valid")).alias("violated"))


def pid_units(export: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct patients of both tables; violated where one of them lacks the patient."""
    return _both_sides(export, expected, ["PID"]).withColumn(
        "violated", ~(F.col("in_observed") & F.col("in_valid")))


def element_units(export: DataFrame, expected: DataFrame) -> DataFrame:
    """Recorded elements of known patients, once per patient (and episode date, if it has one)."""
    grain = lambda df, basic: df.select(
        "PID", F.when(~basic, F.col("Episode_Date")).alias("Episode_Date"), "source_id",
        basic.alias("_basic"))
    recorded = export.filter(has_value(F.col("source_value")))
    recorded = grain(recorded, F.col("Episode_Date").isNull())
    # Without a form type the episode date tells basic from longitudinal.
    by_type = "form_type" in expected.columns
    is_basic = F.col("form_type") == "basic" if by_type else F.col("Episode_Date").isNull()
    usable = expected.filter(F.col("form_type").isin("basic", "longitudinal")) if by_type else expected
    wanted = grain(usable, is_basic).filter(F.col("_basic") | F.col("Episode_Date").isNotNull())
    keys = ["PID", "_basic", "_date", "source_id"]
    dated = lambda df: df.withColumn("_date", F.coalesce("Episode_Date", F.lit("")))
    units = _both_sides(dated(recorded), dated(wanted), keys).filter("in_observed")
    known = expected.filter("PID is not null").select("PID").distinct()
    return units.join(known, "PID", "left_semi").select(
        "PID", F.when(~F.col("_basic"), F.col("_date")).alias("Episode_Date"), "source_id",
        (~F.col("in_valid")).alias("violated"))


def element_units_of_versions(export: DataFrame, versions: DataFrame, form_elements: DataFrame,
                              violated_only: bool = False) -> DataFrame:
    """X3 from form versions and the elements of forms: as :func:`element_units` of the expected elements, or the violated
    ones of these, but what is shuffled is a row per patient and episode with marks. Marks become a row per element last.
    """
    marks, words = element_marks(clean(form_elements, ["source_id"]))
    per_episode = _marked_units(export, versions, form_elements, marks, words, of_forms=False)
    has, valid = [lambda w, s=s: F.col(f"{s}{w}") for s in ("_has", "_valid")]
    asked = (lambda w: has(w).bitwiseAND(F.bitwise_not(valid(w)))) if violated_only else has
    units = per_episode.filter(F.col("PID").isNotNull() & reduce(Column.__or__, [asked(w) != 0 for w in range(words)],
                                                                 F.col("_own")))
    # Ids are trimmed like those of the units, and patients are as many as the registry has, so both sides are shuffled.
    known = clean_expected(versions).filter("PID is not null").select("PID").distinct()
    units = units.join(known.hint("merge"), "PID", "left_semi")
    in_set = lambda bits, m: F.get(F.array(*[bits(w) for w in range(words)]), m["word"]).bitwiseAND(m["bit"]) != 0
    failed = lambda source, violated: F.struct(source.alias("source_id"), violated.alias("violated"))
    named = F.transform(F.filter(_places(marks), lambda m: in_set(asked, m)), lambda m: failed(m["id"], ~in_set(valid, m)))
    return units.select("PID", "Episode_Date", F.inline(F.when(
        F.col("_own"), F.array(failed(F.col("source_id"), F.lit(True)))).otherwise(named)))


def _places(marks: DataFrame) -> Column:
    """All marked elements, which are rule rows, as an array of their ids and the places of their marks."""
    nothing = F.array().cast("array<struct<id: string, word: int, bit: bigint>>")
    places = [F.struct(F.lit(m["source_id"]).alias("id"), F.lit(m["_word"]).alias("word"), F.lit(m["_bit"]).alias("bit"))
              for m in marks.collect()]
    return F.array(*places) if places else nothing


def form_version_units(expected: DataFrame, form_elements: DataFrame) -> DataFrame:
    """Distinct form versions of the expected elements; violated where the form metadata lacks them."""
    elements = clean(form_elements, ["form_id", "form_version"])
    return _both_sides(expected, elements, ["form_id", "form_version"]).filter("in_observed").select(
        "form_id", "form_version", (~F.col("in_valid")).alias("violated"))


def source_id_violations(found: DataFrame) -> DataFrame:
    return source_id_violations_of(found.filter("violated"))


def source_id_violations_of(failed: DataFrame) -> DataFrame:
    return _violation(failed, SOURCE_ID, F.col("source_id"))


def pid_violations(found: DataFrame) -> DataFrame:
    return pid_violations_of(found.filter("violated"))


def pid_violations_of(failed: DataFrame) -> DataFrame:
    return _violation(failed, PID_MAPPING, F.when(
        F.col("in_observed"), fixed.PID_ONLY_IN_EXPORT).otherwise(fixed.PID_ONLY_IN_EXPECTED))


def element_violations(found: DataFrame) -> DataFrame:
    return element_violations_of(found.filter("violated"))


def element_violations_of(failed: DataFrame) -> DataFrame:
    return _violation(failed, ELEMENT, F.concat_ws(
        " | ", "PID", F.coalesce("Episode_Date", F.lit(fixed.BASIC_EPISODE)), "source_id"))


def form_version_violations(found: DataFrame) -> DataFrame:
    return form_version_violations_of(found.filter("violated"))


def form_version_violations_of(failed: DataFrame) -> DataFrame:
    return _violation(failed, FORM_VERSION, F.concat(
        "form_id", F.lit(" | version "), "form_version"))


KEYS = ("rule_id", "PID", "grain", "Episode_Date", "source_id", "form_id", "form_version")


def _keyed(rows: DataFrame, observed: bool, *keys: tuple[Column, str, dict]) -> DataFrame:
    """Rows as keys of the given rules, (condition, rule, parts of the key), marked with their side."""
    nothing = F.lit(None).cast("string")
    whole = lambda rule, parts: F.struct(*[
        (F.lit(rule) if k == "rule_id" else parts.get(k, nothing)).alias(k) for k in KEYS])
    found = F.array_compact(F.array(*[F.when(given, whole(rule, parts)) for given, rule, parts in keys]))
    return rows.select(F.inline(found)).withColumns({"in_observed": F.lit(observed), "in_valid": F.lit(not observed)})


def units(export: DataFrame, dictionary: DataFrame, expected: DataFrame, form_elements: DataFrame) -> DataFrame:
    """X1-X4 in one reduction: distinct keys of all four rules with the sides they occur on.

    Every table is read once. A row becomes the keys of the rules it matters to; equal keys combine before the shuffle.
    """
    export, expected = clean_export(export), clean_expected(expected)
    known, elements = clean(dictionary, ["source_id"]), clean(form_elements, ["form_id", "form_version"])
    pid, date, source = F.col("PID"), F.col("Episode_Date"), F.col("source_id")
    form = {"form_id": F.col("form_id"), "form_version": F.col("form_version")}
    has_form = F.col("form_id").isNotNull() & F.col("form_version").isNotNull()
    # Without a form type the episode date tells basic from longitudinal.
    by_type = "form_type" in expected.columns
    is_basic = F.col("form_type") == "basic" if by_type else date.isNull()
    usable = F.col("form_type").isin("basic", "longitudinal") if by_type else F.lit(True)
    cell = lambda basic: {"PID": pid, "source_id": source, "grain": F.when(basic, "basic").otherwise("longitudinal"),
                          "Episode_Date": F.when(~basic, date)}
    whole = pid.isNotNull() & source.isNotNull()
    sides = [
        _keyed(export, True, (source.isNotNull(), SOURCE_ID, {"source_id": source}), (pid.isNotNull(), PID_MAPPING, {"PID": pid}),
               (whole & has_value(F.col("source_value")), ELEMENT, cell(date.isNull()))),
        _keyed(known, False, (source.isNotNull(), SOURCE_ID, {"source_id": source})),
        _keyed(expected.withColumn("_side", F.explode(F.array(F.lit(True), F.lit(False)))), False,
               (~F.col("_side") & pid.isNotNull(), PID_MAPPING, {"PID": pid}),
               (~F.col("_side") & whole & usable & (is_basic | date.isNotNull()), ELEMENT, cell(is_basic)),
               (F.col("_side") & has_form, FORM_VERSION, form)).withColumns({
                   side: F.when(F.col("rule_id") == FORM_VERSION, ~F.col(side)).otherwise(F.col(side))
                   for side in ("in_observed", "in_valid")}),
        _keyed(elements, False, (has_form, FORM_VERSION, form)),
    ]
    return reduce(DataFrame.unionByName, sides).groupBy(*KEYS).agg(
        F.max("in_observed").alias("in_observed"), F.max("in_valid").alias("in_valid"))


def violations_of(all_units: DataFrame) -> DataFrame:
    """X6 from :func:`units`, which are best stored before, as they are read twice."""
    rule = F.col("rule_id")
    known = all_units.filter((rule == PID_MAPPING) & F.col("in_valid")).select("PID")
    failed = all_units.filter(F.when(rule == PID_MAPPING, ~F.col("in_observed") | ~F.col("in_valid")).otherwise(
        F.col("in_observed") & ~F.col("in_valid")))
    of = lambda name: failed.filter(rule == name)
    return (
        source_id_violations_of(of(SOURCE_ID))
        .unionByName(pid_violations_of(of(PID_MAPPING)))
        .unionByName(element_violations_of(of(ELEMENT).join(known, "PID")))
        .unionByName(form_version_violations_of(of(FORM_VERSION)))
    )


def summary_of(all_units: DataFrame) -> DataFrame:
    """X6 from :func:`units`, read once: counted per patient first, as elements count for known patients only."""
    rule, observed, valid = F.col("rule_id"), F.col("in_observed"), F.col("in_valid")
    assessed = F.when(rule == PID_MAPPING, F.lit(True)).otherwise(observed)
    violated = assessed & ~(observed & valid)
    rules = [r[0] for r in fixed.RELATIONAL_RULES]
    per_patient = all_units.groupBy("PID").agg(
        F.max((rule == PID_MAPPING) & valid).alias("known"),
        *[F.count_if((rule == r) & assessed).alias(f"a{i}") for i, r in enumerate(rules)],
        *[F.count_if((rule == r) & violated).alias(f"v{i}") for i, r in enumerate(rules)])
    counts = lambda name, r: F.coalesce(F.sum(F.when(F.col("known") | (r != ELEMENT), F.col(name))), F.lit(0))
    flags = per_patient.agg(F.array(*[
        F.struct(F.lit(r).alias("rule_id"), counts(f"a{i}", r).alias("assessed"), counts(f"v{i}", r).alias("violated"))
        for i, r in enumerate(rules)]).alias("rules")).select(F.inline("rules"))
    return make_summary(flags, [(r, fixed.RELATIONAL_RULE_TYPE) for r in rules])


def violations(export, dictionary, expected, form_elements) -> DataFrame:
    """X6."""
    return violations_of(units(export, dictionary, expected, form_elements))


def summary(export, dictionary, expected, form_elements) -> DataFrame:
    """X6."""
    return summary_of(units(export, dictionary, expected, form_elements))


MARKED_KEYS = ("PID", "Episode_Date", "source_id", "form_id", "form_version")


def _marked_units(export: DataFrame, versions: DataFrame, form_elements: DataFrame, marks: DataFrame, words: int,
                  of_forms: bool = True) -> DataFrame:
    """X1-X4, without ``of_forms`` X1-X3, as in :func:`units`, but a row per patient and episode with marks of its elements: those the export names
    (``_seen``), those it has a value of (``_has``) and those its form versions ask for (``_valid``).

    Elements that no form has are rows of their own, and so are form versions. A date tells longitudinal from basic.
    """
    nothing, sets = F.lit(None).cast("string"), ("_seen", "_has", "_valid")

    def side(rows: DataFrame, observed: bool, keys: dict, bits: dict, own_value=F.lit(False)) -> DataFrame:
        given = {f"{s}{w}": bits[s](w) if s in bits else F.lit(None).cast("bigint") for s in sets for w in range(words)}
        return rows.select(*[keys.get(k, nothing).alias(k) for k in MARKED_KEYS], F.lit(observed).alias("in_observed"),
                           F.lit(not observed).alias("in_valid"), own_value.alias("_own"),
                           *[c.alias(n) for n, c in given.items()])

    form = {k: F.col(k) for k in ("form_id", "form_version")}
    whole = lambda rows: rows.dropna(subset=list(form))
    cells = clean_export(export).withColumn("_filled", has_value(F.col("source_value"))).join(
        F.broadcast(marks), "source_id", "left")
    known = F.col("_bit").isNotNull()
    mark = lambda w: F.when(F.col("_word") == w, F.col("_bit"))
    observed = side(
        cells, True, {"PID": F.col("PID"), "Episode_Date": F.col("Episode_Date"), "source_id": F.when(~known, F.col("source_id"))},
        {"_seen": mark, "_has": lambda w: F.when(F.col("_filled"), mark(w))},
        ~known & F.col("source_id").isNotNull() & F.col("_filled"))
    # Versions meet their elements by the keys as given, which are trimmed after that.
    own = clean(form_elements, ["source_id"]).join(F.broadcast(marks), "source_id").groupBy(*form).agg(
        *[F.bit_or(mark(w)).alias(f"_own{w}") for w in range(words)])
    wanted = clean_expected(versions.join(F.broadcast(own), list(form), "left"))
    basic, date = F.col("form_type") == "basic", F.col("Episode_Date")
    usable = F.col("form_type").isin("basic", "longitudinal") & (basic | date.isNotNull())
    # Of a version, once for its patient and once for itself: the second is what is observed, and the metadata valid.
    of_what = [F.lit(False), F.lit(True)] if of_forms else [F.lit(False)]
    wanted = wanted.withColumn("_of_form", F.explode(F.array(*of_what))).filter(
        F.when(F.col("_of_form"), F.col("form_id").isNotNull() & F.col("form_version").isNotNull()).otherwise(
            F.col("PID").isNotNull()))
    of_patient = lambda c: F.when(~F.col("_of_form"), c)
    valid = side(
        wanted, False, {"PID": of_patient(F.col("PID")), "Episode_Date": of_patient(F.when(~basic, date)),
                        **{k: F.when(F.col("_of_form"), c) for k, c in form.items()}},
        {"_valid": lambda w: of_patient(F.when(usable, F.col(f"_own{w}")))}).withColumns({
            "in_observed": F.col("form_id").isNotNull(), "in_valid": F.col("form_id").isNull()})
    metadata = side(whole(clean(form_elements, list(form))), False, form, {})
    return reduce(DataFrame.unionByName, [observed, valid, *([metadata] if of_forms else [])]).groupBy(*MARKED_KEYS).agg(
        *[F.max(c).alias(c) for c in ("in_observed", "in_valid", "_own")],
        *[F.coalesce(F.bit_or(f"{s}{w}"), F.lit(0)).alias(f"{s}{w}") for s in sets for w in range(words)])


def summary_of_versions(export: DataFrame, dictionary: DataFrame, versions: DataFrame, form_elements: DataFrame) -> DataFrame:
    """X6 from form versions and the elements of forms: what :func:`summary` has from the expected elements.

    Marks are counted per patient; the window holds a patient's row and one for each element that no form has.
    """
    marks, words = element_marks(clean(form_elements, ["source_id"]))
    each, group = range(words), ["source_id", "form_id", "form_version"]
    own, pid = F.col("_own").cast("bigint"), F.col("PID").isNotNull()
    count = lambda bits: reduce(Column.__add__, [F.bit_count(bits(w)) for w in each], own)
    per_patient = _marked_units(export, versions, form_elements, marks, words).groupBy("PID", *group).agg(
        F.max("in_observed").alias("in_observed"), F.max("in_valid").alias("in_valid"),
        *[F.bit_or(f"_seen{w}").alias(f"_seen{w}") for w in each],
        F.sum(count(lambda w: F.col(f"_has{w}"))).alias("_assessed"),
        F.sum(count(lambda w: F.col(f"_has{w}").bitwiseAND(F.bitwise_not(f"_valid{w}")))).alias("_violated"))
    of_patient = Window.partitionBy("PID")
    one, known = F.col("_place") == 1, F.col("_known")
    totals = per_patient.withColumns({
        "_known": pid & F.max("in_valid").over(of_patient), "_both": F.max("in_observed").over(of_patient),
        "_place": F.row_number().over(of_patient.orderBy(*group))}).groupBy(*group).agg(
        F.max("in_observed").alias("in_observed"), F.max("in_valid").alias("in_valid"),
        F.array(*[F.bit_or(f"_seen{w}") for w in each]).alias("_seen"),
        F.coalesce(F.sum(F.when(known, F.col("_assessed"))), F.lit(0)).alias("_assessed"),
        F.coalesce(F.sum(F.when(known, F.col("_violated"))), F.lit(0)).alias("_violated"),
        F.count_if(pid & one).alias("_patients"), F.count_if(pid & one & ~(known & F.col("_both"))).alias("_foreign"))
    places = [F.struct(F.lit(m["source_id"]).alias("id"), F.lit(m["_word"]).alias("word"), F.lit(m["_bit"]).alias("bit"))
              for m in marks.collect()]
    named = F.array().cast("array<string>") if not places else F.transform(F.filter(
        F.array(*places), lambda m: F.get("_seen", m["word"]).bitwiseAND(m["bit"]) != 0), lambda m: m["id"])
    ids = F.when(F.col("source_id").isNotNull(), F.array("source_id")).otherwise(named)
    counted = lambda rule, assessed, violated: F.struct(
        F.lit(rule).alias("rule_id"), F.lit(None).cast("string").alias("id"), assessed.cast("bigint").alias("assessed"),
        violated.cast("bigint").alias("violated"))
    seen, valid = F.col("in_observed"), F.col("in_valid")
    flags = totals.select(F.inline(F.when(F.col("form_id").isNotNull(), F.array(
        counted(FORM_VERSION, seen, seen & ~valid))).otherwise(F.concat(
            F.array(counted(PID_MAPPING, F.col("_patients"), F.col("_foreign")),
                    counted(ELEMENT, F.col("_assessed"), F.col("_violated"))),
            F.transform(ids, lambda i: F.struct(
                F.lit(SOURCE_ID).alias("rule_id"), i.alias("id"), F.lit(1).cast("bigint").alias("assessed"),
                F.lit(0).cast("bigint").alias("violated")))))))
    listed = clean(dictionary, ["source_id"]).select(F.col("source_id").alias("id"), F.lit(0).alias("_listed")).distinct()
    return make_summary(flags.join(listed, "id", "left").withColumn("violated", F.when(
        F.col("id").isNotNull(), F.coalesce("_listed", F.lit(1)).cast("bigint")).otherwise(F.col("violated"))),
        [(r[0], fixed.RELATIONAL_RULE_TYPE) for r in fixed.RELATIONAL_RULES])
