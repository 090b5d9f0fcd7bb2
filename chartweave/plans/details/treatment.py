"""Detail tables of medication requests, immunizations and care plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import array_from_json, dosage_class, first_of, ref_to_id, struct_from_json
from ...operators.keyed import one_per_key
from ...schemas import CONCEPT, REFERENCE_LIST
from .registry import BATCH, detail, per_element, shape


def _medication_code() -> Column:
    return first_of("data.medicationCodeableConcept.coding")["code"]


def _request_id() -> Column:
    """Requests carry no id of their own: encounter and medication identify them."""
    return F.concat_ws("_", ref_to_id("data.context.reference"), _medication_code())


@detail("MedicationRequest")
def medication_request(rows: DataFrame) -> DataFrame:
    return shape(
        rows,
        medication_request_id=_request_id(),
        patient_id=ref_to_id("data.patient.reference"),
        dateWritten="data.dateWritten",
        encounter_id=ref_to_id("data.context.reference"),
        medicationCode=_medication_code(),
        status="data.status",
        reasonReference=ref_to_id(first_of(array_from_json("data.reasonReference", REFERENCE_LIST))["reference"]),
        medication_class=dosage_class("data.dosageInstruction"),
    )


@detail("MedicationRequest")
def medication(rows: DataFrame) -> DataFrame:
    coded = per_element(rows, "drug", "data.medicationCodeableConcept.coding")
    return one_per_key(shape(coded, code="drug.code", display="drug.display"), BATCH, "code")


def _dosages(rows: DataFrame) -> DataFrame:
    return per_element(rows, "dose", "data.dosageInstruction", medication_request_id=_request_id())


@detail("MedicationRequest")
def dosage_instruction(rows: DataFrame) -> DataFrame:
    return shape(
        _dosages(rows),
        medication_request_id="medication_request_id",
        asNeededBoolean="dose.asNeededBoolean",
        sequence="dose.sequence",
        frequency="dose.timing.repeat.frequency",
        period="dose.timing.repeat.period",
        periodUnit="dose.timing.repeat.periodUnit",
        doseQuantity="dose.doseQuantity.value",
        additionalInstructionsCode=first_of(first_of("dose.additionalInstructions")["coding"])["code"],
    )


@detail("MedicationRequest")
def additional_instruction(rows: DataFrame) -> DataFrame:
    """Every coding of every instruction of every dosage."""
    keep = {"medication_request_id": "medication_request_id"}
    notes = per_element(_dosages(rows), "note", "dose.additionalInstructions", **keep)
    codings = per_element(notes, "coding", "note.coding", **keep)
    return shape(codings, **keep, code="coding.code", display="coding.display")


@detail("MedicationRequest")
def dispense_request(rows: DataFrame) -> DataFrame:
    return shape(
        rows,
        medication_request_id=_request_id(),
        numberOfRepeatsAllowed="data.dispenseRequest.numberOfRepeatsAllowed",
        quantityValue="data.dispenseRequest.quantity.value",
        quantityUnit="data.dispenseRequest.quantity.unit",
        expectedSupplyDurationValue="data.dispenseRequest.expectedSupplyDuration.value",
        expectedSupplyDurationUnit="data.dispenseRequest.expectedSupplyDuration.unit",
    )


@detail("Immunization")
def immunization(rows: DataFrame) -> DataFrame:
    coded = per_element(
        rows,
        "vaccine",
        "data.vaccineCode.coding",
        patient_id=ref_to_id("data.patient.reference"),
        encounter_id=ref_to_id("data.encounter.reference"),
        given_on="data.date",
        status="data.status",
        wasNotGiven="data.wasNotGiven",
        primarySource="data.primarySource",
    )
    return shape(
        coded,
        patient_id="patient_id",
        encounter_id="encounter_id",
        vaccineCode="vaccine.code",
        date="given_on",
        status="status",
        wasNotGiven="wasNotGiven",
        primarySource="primarySource",
    )


@detail("Immunization")
def vaccine_code(rows: DataFrame) -> DataFrame:
    coded = per_element(rows, "vaccine", "data.vaccineCode.coding")
    return one_per_key(shape(coded, code="vaccine.code", display="vaccine.display"), BATCH, "code")


def _steps(rows: DataFrame, **carry) -> DataFrame:
    """Care plans per activity and address."""
    kept = {name: name for name in carry}
    activities = per_element(rows, "step", "data.activity", targets="data.addresses", **carry)
    return per_element(activities, "target", "targets", step="step", **kept)


def _category_coding(text: Column | str) -> Column:
    return first_of(struct_from_json(text, CONCEPT)["coding"])


@detail("CarePlan")
def careplan(rows: DataFrame) -> DataFrame:
    steps = _steps(
        rows,
        patient_id=ref_to_id("data.subject.reference"),
        encounter_id=ref_to_id("data.context.reference"),
        status="data.status",
        periodStart="data.period.start",
        periodEnd="data.period.end",
        categoryCode=_category_coding(first_of("data.category"))["code"],
    )
    return shape(
        steps,
        patient_id="patient_id",
        encounter_id="encounter_id",
        address_id=ref_to_id("target.reference"),
        status="status",
        activityStatus="step.detail.status",
        periodStart="periodStart",
        periodEnd="periodEnd",
        activityCode=first_of("step.detail.code.coding")["code"],
        categoryCode="categoryCode",
    )


@detail("CarePlan")
def careplan_activity(rows: DataFrame) -> DataFrame:
    """First coding of each activity, repeated for each address of the plan."""
    coding = first_of("step.detail.code.coding")
    return shape(_steps(rows), code=coding["code"], display=coding["display"])


@detail("CarePlan")
def careplan_category(rows: DataFrame) -> DataFrame:
    """First coding of each category, repeated for each activity and address of the plan."""
    categories = per_element(_steps(rows, groups="data.category"), "group", "groups")
    # a one-element array keeps the parsed coding together; two separate fields would be parsed twice
    coded = per_element(categories, "coding", F.array(_category_coding("group")))
    return shape(coded, code="coding.code", display="coding.display")
