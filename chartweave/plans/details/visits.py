"""Detail tables of encounters and procedures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ...functions import array_from_json, first_of, period_bound, ref_to_id, struct_from_json
from ...operators.keyed import one_per_key
from ...schemas import CONCEPT_LIST, REFERENCE
from .registry import BATCH, detail, per_element, shape


def _kinds() -> Column:
    """The encounter's type arrives as the text of a list of concepts."""
    return array_from_json("data.type", CONCEPT_LIST)


@detail("Encounter")
def encounter(rows: DataFrame) -> DataFrame:
    """One row per encounter and type."""
    typed = per_element(
        rows,
        "kind",
        _kinds(),
        encounter_id="data.id",
        patient_id=ref_to_id("data.patient.reference"),
        status="data.status",
        visit_class="data.class.code",
        reason_code=first_of("data.reason.coding")["code"],
        periodStart="data.period.start",
        periodEnd="data.period.end",
    )
    return shape(
        typed,
        encounter_id="encounter_id",
        patient_id="patient_id",
        status="status",
        **{"class": "visit_class"},
        type_code=first_of("kind.coding")["code"],
        reason_code="reason_code",
        periodStart="periodStart",
        periodEnd="periodEnd",
    )


@detail("Encounter")
def encounter_type(rows: DataFrame) -> DataFrame:
    kinds = per_element(rows, "kind", _kinds())
    return one_per_key(shape(kinds, code=first_of("kind.coding")["code"], display="kind.text"), BATCH, "code")


@detail("Encounter")
def encounter_reason(rows: DataFrame) -> DataFrame:
    """Reason codings, repeated for each type of the encounter."""
    kinds = per_element(rows, "kind", _kinds(), reasons="data.reason.coding")
    reasons = per_element(kinds, "why", "reasons")
    return shape(reasons, code="why.code", display="why.display")


@detail("Procedure")
def procedure(rows: DataFrame) -> DataFrame:
    return shape(
        rows,
        patient_id=ref_to_id("data.subject.reference"),
        encounter_id=ref_to_id("data.encounter.reference"),
        reasonReference=ref_to_id(struct_from_json("data.reasonReference", REFERENCE)["reference"]),
        procedureType=first_of("data.code.coding")["code"],
        status="data.status",
        performedPeriodStart=period_bound("data.performedPeriod.start", "data.performedDateTime"),
        performedPeriodEnd=period_bound("data.performedPeriod.end", "data.performedDateTime"),
    )


@detail("Procedure")
def procedure_type(rows: DataFrame) -> DataFrame:
    return shape(per_element(rows, "kind", "data.code.coding"), code="kind.code", display="kind.display")
