"""Detail tables of conditions, observations, diagnostic reports and allergies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import condition_category, first_of, ref_to_id
from ...operators.keyed import one_per_key
from .registry import BATCH, detail, per_element, shape


@detail("Condition")
def condition(rows: DataFrame) -> DataFrame:
    coded = per_element(
        rows,
        "finding",
        "data.code.coding",
        condition_id="data.id",
        onsetDateTime="data.onsetDateTime",
        clinicalStatus="data.clinicalStatus",
        verificationStatus="data.verificationStatus",
        patient_id=ref_to_id("data.subject.reference"),
        encounter_id=ref_to_id("data.context.reference"),
        abatementDateTime="data.abatementDateTime",
    )
    return shape(
        coded,
        condition_id="condition_id",
        onsetDateTime="onsetDateTime",
        clinicalStatus="clinicalStatus",
        verificationStatus="verificationStatus",
        code="finding.code",
        patient_id="patient_id",
        encounter_id="encounter_id",
        abatementDateTime="abatementDateTime",
    )


@detail("Condition")
def condition_code(rows: DataFrame) -> DataFrame:
    """The category is a function of the display, so it is worked out after the codes are reduced."""
    coded = per_element(rows, "finding", "data.code.coding")
    codes = one_per_key(shape(coded, code="finding.code", display="finding.display"), BATCH, "code")
    return codes.withColumn("category", condition_category("display"))


@detail("Observation")
def observation(rows: DataFrame) -> DataFrame:
    return shape(
        rows,
        observation_id="data.id",
        status="data.status",
        issued="data.issued",
        effectiveDateTime="data.effectiveDateTime",
        patient_id=ref_to_id("data.subject.reference"),
        encounter_id=ref_to_id("data.encounter.reference"),
        code=first_of("data.code.coding")["code"],
    )


@detail("Observation")
def observation_result(rows: DataFrame) -> DataFrame:
    """The observation's own quantity, its components and its coded values, read in one pass.

    Per row the three kinds become one array of equal structs, so the input is scanned once and not
    three times. Values are text because quantities and concepts share the column.
    """

    def result(value, unit, code):
        return F.struct(value.cast("string").alias("value"), unit.alias("unit"), code.alias("code"))

    def quantity(of, code):
        return result(of["value"], of["unit"], code)

    data = F.col("data")
    own = F.array(quantity(data["valueQuantity"], first_of("data.code.coding")["code"]))
    parts = F.flatten(
        F.transform(
            F.filter(data["component"], lambda part: part["code"]["coding"].isNotNull()),
            lambda part: F.transform(
                part["code"]["coding"], lambda coding: quantity(part["valueQuantity"], coding["code"])
            ),
        )
    )
    coded = F.transform(
        data["valueCodeableConcept"]["coding"], lambda coding: result(coding["display"], F.lit("concept"), coding["code"])
    )
    nothing = F.filter(own, lambda _: F.lit(False))
    everything = F.concat(own, F.coalesce(parts, nothing), F.coalesce(coded, nothing))
    results = per_element(rows, "found", everything, observation_id="data.id")
    return shape(results, observation_id="observation_id", value="found.value", unit="found.unit", code="found.code")


@detail("Observation")
def observation_code(rows: DataFrame) -> DataFrame:
    """Distinct codes of observations and of their components."""
    whole = shape(per_element(rows, "kind", "data.code.coding"), code="kind.code", display="kind.display")
    parts = per_element(per_element(rows, "part", "data.component"), "kind", "part.code.coding")
    return whole.unionByName(shape(parts, code="kind.code", display="kind.display")).distinct()


def _reports(rows: DataFrame, **carry) -> DataFrame:
    """Diagnostic reports per coding and result."""
    coded = per_element(rows, "kind", "data.code.coding", results="data.result", **carry)
    return per_element(coded, "outcome", "results", kind="kind", **{name: name for name in carry})


@detail("DiagnosticReport")
def diagnostic(rows: DataFrame) -> DataFrame:
    reports = _reports(
        rows,
        diagnostic_id="data.id",
        status="data.status",
        issued="data.issued",
        effectiveDateTime="data.effectiveDateTime",
        patient_id=ref_to_id("data.subject.reference"),
        encounter_id=ref_to_id("data.encounter.reference"),
    )
    names = ["diagnostic_id", "status", "issued", "effectiveDateTime", "patient_id", "encounter_id"]
    return shape(reports, **{n: n for n in names}, report_code="kind.code")


@detail("DiagnosticReport")
def diagnostic_result(rows: DataFrame) -> DataFrame:
    return shape(
        _reports(rows, diagnostic_id="data.id"),
        diagnostic_id="diagnostic_id",
        result_id=ref_to_id("outcome.reference"),
        display="outcome.display",
    )


@detail("DiagnosticReport")
def diagnostic_code(rows: DataFrame) -> DataFrame:
    return one_per_key(shape(_reports(rows), code="kind.code", display="kind.display"), BATCH, "code")


@detail("AllergyIntolerance")
def allergy(rows: DataFrame) -> DataFrame:
    """One row per coding and category."""
    coded = per_element(
        rows,
        "kind",
        "data.code.coding",
        criticality="data.criticality",
        patient_id=ref_to_id("data.patient.reference"),
        clinicalStatus="data.clinicalStatus",
        assertedDate="data.assertedDate",
        groups="data.category",
    )
    names = ["criticality", "patient_id", "clinicalStatus", "assertedDate"]
    grouped = per_element(coded, "category", "groups", kind="kind", **{n: n for n in names})
    return shape(grouped, **{n: n for n in names}, allergy_code="kind.code")


@detail("AllergyIntolerance")
def allergy_code(rows: DataFrame) -> DataFrame:
    coded = per_element(rows, "kind", "data.code.coding", type="data.type", groups="data.category")
    grouped = per_element(coded, "category", "groups", kind="kind", type="type")
    codes = shape(grouped, code="kind.code", display="kind.display", type="type", category="category")
    return one_per_key(codes, BATCH, "code")
