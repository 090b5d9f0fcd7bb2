"""The star schema: thirty typed tables in four groups, declared once.

A spec gives, for every column, the detail column it comes from and its type. Renaming, parsing, table
definitions and load behaviour all follow from it. A table with a key is merged (the last row wins),
a table without one is appended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_date, parse_timestamp
from ..operators.keyed import dedupe_full_row, latest_per_key
from .details.registry import BATCH

#: column of stored star rows: the number of the load among those of all sources
LOAD = "load_sequence"


@dataclass(frozen=True)
class Field:
    source: str
    type: str = "string"
    parse: str | None = None  # "date" or "timestamp" for text that has to be parsed

    def value(self) -> Column:
        raw = F.col(self.source)
        if self.parse == "date":
            return parse_date(raw).cast(self.type)
        if self.parse == "timestamp":
            return parse_timestamp(raw).cast(self.type)
        if self.type == "int":
            # whole numbers are rounded to nearest, as a database column assignment does
            return F.rint(raw.cast("double")).cast("int")
        return raw.cast(self.type)


def day(source: str) -> Field:
    return Field(source, "date", "date")


def midnight(source: str) -> Field:
    """A day stored in a timestamp column."""
    return Field(source, "timestamp", "date")


def instant(source: str) -> Field:
    return Field(source, "timestamp", "timestamp")


def whole(source: str) -> Field:
    return Field(source, "int")


def real(source: str) -> Field:
    return Field(source, "double")


def flag(source: str) -> Field:
    return Field(source, "boolean")


@dataclass(frozen=True)
class StarTable:
    group: str
    name: str
    source: str
    fields: dict[str, Field]
    key: str | None = None
    keep_first: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.group}.{self.name}"

    @property
    def columns(self) -> list[str]:
        return list(self.fields)

    @property
    def is_code_table(self) -> bool:
        """Keyed by a code that the records repeat over and over."""
        return self.key is not None and self.fields[self.key].source == "code"

    @property
    def ddl(self) -> str:
        return ", ".join(f"{c} {f.type.upper()}" for c, f in self.fields.items())


# The names of tables, columns and keys below are those of the published star schema.
STAR: dict[str, StarTable] = {}


def _table(group, name, source, key=None, keep_first=(), **fields):
    typed = {c: Field(f) if isinstance(f, str) else f for c, f in fields.items()}
    STAR[name] = StarTable(group, name, source, typed, key, tuple(keep_first))


# --- patient -------------------------------------------------------------------------------------
_table(
    "patient", "dim_patient", "patient", key="patient_key",
    patient_key="patient_id", gender="gender", birth_date=day("birthDate"),
    deceased_date_time=instant("deceasedDateTime"), multiple_birth=whole("multipleBirth"),
    marital_status="maritalStatus",
)
_table(
    "patient", "dim_patient_name", "patient_name",
    patient_key="patient_id", name_use="use", last_name="family", first_name="given", prefix="prefix",
    suffix="suffix",
)
_table(
    "patient", "dim_patient_address", "patient_address",
    patient_key="patient_id", latitude=real("latitude"), longitude=real("longitude"), city="city",
    state="state", postal_code="postalCode", address_line="line",
)
_table(
    "patient", "dim_patient_telecom", "patient_telecom",
    patient_key="patient_id", telecom_system="system", telecom_value="value", telecom_use="use",
    okay_to_leave_message=flag("okay_to_leave_message"),
)
_table(
    "patient", "dim_patient_extension", "patient_extension",
    patient_key="patient_id", extension_type="type", extension_value="value",
)

# --- encounter -----------------------------------------------------------------------------------
_table(
    "encounter", "dim_encounter_type", "encounter_type", key="encounter_type_key",
    encounter_type_key="code", encounter_type_name="display",
)
_table(
    "encounter", "dim_encounter_reason", "encounter_reason", key="encounter_reason_key",
    encounter_reason_key="code", encounter_reason_name="display",
)
_table(
    "encounter", "fact_encounter", "encounter", key="encounter_key",
    encounter_key="encounter_id", patient_key="patient_id", encounter_status="status",
    encounter_class="class", encounter_type_key="type_code", encounter_reason_key="reason_code",
    period_start=instant("periodStart"), period_end=instant("periodEnd"),
)

# --- clinical ------------------------------------------------------------------------------------
_table(
    "clinical", "dim_vaccine_code", "vaccine_code", key="vaccine_code_key",
    vaccine_code_key="code", vaccine_name="display",
)
_table(
    "clinical", "dim_procedure_type", "procedure_type", key="procedure_type_key",
    procedure_type_key="code", procedure_type_name="display",
)
_table(
    "clinical", "dim_observation_code", "observation_code", key="observation_code_key",
    observation_code_key="code", observation_name="display",
)
_table(
    "clinical", "dim_diagnostic_code", "diagnostic_code", key="diagnostic_code_key",
    diagnostic_code_key="code", diagnostic_name="display",
)
_table(
    "clinical", "dim_medication", "medication", key="medication_code_key",
    medication_code_key="code", medication_name="display",
)
_table(
    "clinical", "dim_condition_code", "condition_code", key="condition_code_key",
    keep_first=["condition_category"],
    condition_code_key="code", condition_name="display", condition_category="category",
)
_table(
    "clinical", "dim_allergy_code", "allergy_code", key="allergy_code_key",
    allergy_code_key="code", allergy_name="display", type="type", category="category",
)
_table(
    "clinical", "fact_immunization", "immunization",
    patient_key="patient_id", encounter_key="encounter_id", vaccine_code_key="vaccineCode",
    immunization_date=midnight("date"), immunization_status="status", was_not_given=flag("wasNotGiven"),
    primary_source=flag("primarySource"),
)
_table(
    "clinical", "fact_procedure", "procedure",
    patient_key="patient_id", encounter_key="encounter_id", reason_reference="reasonReference",
    procedure_type_key="procedureType", procedure_status="status",
    performed_period_start=instant("performedPeriodStart"),
    performed_period_end=instant("performedPeriodEnd"),
)
_table(
    "clinical", "fact_condition", "condition", key="condition_key",
    condition_key="condition_id", onset_date_time=instant("onsetDateTime"),
    clinical_status="clinicalStatus", verification_status="verificationStatus",
    condition_code_key="code", patient_key="patient_id", encounter_key="encounter_id",
    abatement_date_time=instant("abatementDateTime"),
)
_table(
    "clinical", "fact_observation", "observation", key="observation_key",
    observation_key="observation_id", observation_status="status", issued=instant("issued"),
    effective_date_time=instant("effectiveDateTime"), patient_key="patient_id",
    encounter_key="encounter_id", observation_code_key="code",
)
_table(
    "clinical", "fact_observation_result", "observation_result",
    observation_key="observation_id", observation_code_key="code", observation_value="value",
    observation_unit="unit",
)
_table(
    "clinical", "fact_diagnostic_report", "diagnostic", key="diagnostic_key",
    diagnostic_key="diagnostic_id", diagnostic_status="status", issued=instant("issued"),
    effective_date_time=instant("effectiveDateTime"), patient_key="patient_id",
    encounter_key="encounter_id", diagnostic_code_key="report_code",
)
_table(
    "clinical", "fact_diagnostic_result", "diagnostic_result",
    diagnostic_key="diagnostic_id", result_key="result_id", result_display="display",
)
_table(
    "clinical", "fact_allergy", "allergy",
    criticality="criticality", patient_key="patient_id", clinical_status="clinicalStatus",
    asserted_date=midnight("assertedDate"), allergy_code_key="allergy_code",
)
_table(
    "clinical", "fact_medication_request", "medication_request",
    medication_request_key="medication_request_id", patient_key="patient_id",
    date_written=midnight("dateWritten"), encounter_key="encounter_id",
    medication_code_key="medicationCode", medication_request_status="status",
    reason_reference="reasonReference", medication_class="medication_class",
)
_table(
    "clinical", "fact_dosage_instruction", "dosage_instruction",
    medication_request_key="medication_request_id", as_needed_boolean=flag("asNeededBoolean"),
    sequence=whole("sequence"), frequency=whole("frequency"), period=whole("period"),
    period_unit="periodUnit", dose_quantity=real("doseQuantity"),
    additional_instructions_code="additionalInstructionsCode",
)
_table(
    "clinical", "fact_additional_instruction", "additional_instruction", key="medication_request_key",
    medication_request_key="medication_request_id", additional_instruction_code="code",
    additional_instruction_display="display",
)
_table(
    "clinical", "fact_dispense_request", "dispense_request",
    medication_request_key="medication_request_id",
    number_of_repeats_allowed=whole("numberOfRepeatsAllowed"), quantity_value=real("quantityValue"),
    quantity_unit="quantityUnit", expected_supply_duration_value=real("expectedSupplyDurationValue"),
    expected_supply_duration_unit="expectedSupplyDurationUnit",
)

# --- care ----------------------------------------------------------------------------------------
_table(
    "care", "dim_careplan_category", "careplan_category", key="careplan_category_key",
    careplan_category_key="code", careplan_category_name="display",
)
_table(
    "care", "dim_careplan_activity", "careplan_activity", key="careplan_activity_key",
    careplan_activity_key="code", careplan_activity_name="display",
)
_table(
    "care", "fact_careplan", "careplan",
    patient_key="patient_id", encounter_key="encounter_id", address_key="address_id",
    careplan_status="status", careplan_activity_status="activityStatus", period_start=day("periodStart"),
    period_end=day("periodEnd"), careplan_activity_code_key="activityCode",
    careplan_category_key="categoryCode",
)

# Keys of the facts and the dimensions they point to.
FOREIGN_KEYS = [
    ("dim_patient_name", "patient_key", "dim_patient", "patient_key"),
    ("dim_patient_address", "patient_key", "dim_patient", "patient_key"),
    ("dim_patient_telecom", "patient_key", "dim_patient", "patient_key"),
    ("dim_patient_extension", "patient_key", "dim_patient", "patient_key"),
    ("fact_encounter", "patient_key", "dim_patient", "patient_key"),
    ("fact_encounter", "encounter_type_key", "dim_encounter_type", "encounter_type_key"),
    ("fact_encounter", "encounter_reason_key", "dim_encounter_reason", "encounter_reason_key"),
    ("fact_condition", "condition_code_key", "dim_condition_code", "condition_code_key"),
    ("fact_condition", "patient_key", "dim_patient", "patient_key"),
    ("fact_condition", "encounter_key", "fact_encounter", "encounter_key"),
    ("fact_immunization", "patient_key", "dim_patient", "patient_key"),
    ("fact_immunization", "encounter_key", "fact_encounter", "encounter_key"),
    ("fact_immunization", "vaccine_code_key", "dim_vaccine_code", "vaccine_code_key"),
    ("fact_procedure", "patient_key", "dim_patient", "patient_key"),
    ("fact_procedure", "encounter_key", "fact_encounter", "encounter_key"),
    ("fact_procedure", "procedure_type_key", "dim_procedure_type", "procedure_type_key"),
    ("fact_observation", "patient_key", "dim_patient", "patient_key"),
    ("fact_observation", "encounter_key", "fact_encounter", "encounter_key"),
    ("fact_observation_result", "observation_key", "fact_observation", "observation_key"),
    ("fact_medication_request", "patient_key", "dim_patient", "patient_key"),
    ("fact_medication_request", "encounter_key", "fact_encounter", "encounter_key"),
    ("fact_medication_request", "medication_code_key", "dim_medication", "medication_code_key"),
    ("fact_diagnostic_report", "patient_key", "dim_patient", "patient_key"),
    ("fact_diagnostic_report", "encounter_key", "fact_encounter", "encounter_key"),
    ("fact_allergy", "patient_key", "dim_patient", "patient_key"),
    ("fact_careplan", "patient_key", "dim_patient", "patient_key"),
    ("fact_careplan", "encounter_key", "fact_encounter", "encounter_key"),
]


def model_table(details: DataFrame, table: StarTable) -> DataFrame:
    """Detail rows as typed columns of the star table; the batch id stays beside them."""
    batch = [BATCH] if BATCH in details.columns else []
    return details.select(*batch, *[f.value().alias(c) for c, f in table.fields.items()])


def load_rows(details: DataFrame, table: StarTable) -> DataFrame:
    """What a batch contributes to the table: modelled rows without full-row repeats."""
    return dedupe_full_row(model_table(details, table))


def current_rows(loaded: DataFrame, table: StarTable) -> DataFrame:
    """The table as readers see it: merged by key over all batches, or all appended rows."""
    if table.key is None:
        return loaded.select(*table.columns)
    order = [LOAD, BATCH] if LOAD in loaded.columns else [BATCH]
    rows = loaded.select(*order, *table.columns)
    return latest_per_key(
        rows, [table.key], order, table.keep_first, repeats=table.is_code_table, unique=table.name.startswith("fact_")
    )


def star_table(details: DataFrame, table: StarTable) -> DataFrame:
    """Detail rows of one or more batches to the current star table.

    A keyed merge already leaves one row per key, so only appended tables need the full-row dedupe.
    """
    if table.key is None:
        return current_rows(load_rows(details, table), table)
    return current_rows(model_table(details, table), table)


def create_star_databases(spark: SparkSession, prefix: str = "") -> None:
    for group in dict.fromkeys(t.group for t in STAR.values()):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{group}")


def create_star_tables(spark: SparkSession, location: str, prefix: str = "") -> list[str]:
    """Define the four databases and thirty empty tables, replacing what is there."""
    names = []
    create_star_databases(spark, prefix)
    for table in STAR.values():
        name = f"{prefix}{table.full_name}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({table.ddl}) USING parquet LOCATION '{location}/{table.full_name}'")
        names.append(name)
    return names


def create_batch_table(spark: SparkSession, table: StarTable, prefix: str = "") -> None:
    """Define the table with its declared types, split by source and batch, where there is none."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {prefix}{table.full_name} ({table.ddl}, source STRING, {BATCH} INT) "
        f"USING orc PARTITIONED BY (source, {BATCH})"
    )
