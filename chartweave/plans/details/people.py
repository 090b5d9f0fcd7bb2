"""Detail tables of patients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import best_value, first_of, multiple_birth, url_tail
from ...operators.nested import pair_coordinates
from .registry import detail, per_element, shape


@detail("Patient")
def patient(rows: DataFrame) -> DataFrame:
    return shape(
        rows,
        patient_id="data.id",
        gender="data.gender",
        birthDate="data.birthDate",
        deceasedDateTime="data.deceasedDateTime",
        multipleBirth=multiple_birth("data.multipleBirthBoolean", "data.multipleBirthInteger"),
        maritalStatus=first_of("data.maritalStatus.coding")["code"],
    )


@detail("Patient")
def patient_name(rows: DataFrame) -> DataFrame:
    """Given x prefix x suffix of each name; a name that lacks one of the three has no row."""
    names = per_element(rows, "person", "data.name", patient_id="data.id")
    keep = {"patient_id": "patient_id", "use": "use", "family": "family"}
    given = per_element(
        names,
        "given",
        "person.given",
        patient_id="patient_id",
        use="person.use",
        family="person.family",
        prefixes="person.prefix",
        suffixes="person.suffix",
    )
    prefixed = per_element(given, "prefix", "prefixes", **keep, given="given", suffixes="suffixes")
    return per_element(prefixed, "suffix", "suffixes", **keep, given="given", prefix="prefix")


@detail("Patient")
def patient_address(rows: DataFrame) -> DataFrame:
    """Addresses with coordinates; latitude and longitude are paired inside the address."""
    homes = per_element(rows, "home", "data.address", patient_id="data.id")
    located = per_element(
        homes,
        "point",
        pair_coordinates(F.col("home")),
        patient_id="patient_id",
        city="home.city",
        state="home.state",
        postalCode="home.postalCode",
        line=first_of("home.line"),
    )
    return shape(
        located,
        patient_id="patient_id",
        latitude="point.latitude",
        longitude="point.longitude",
        city="city",
        state="state",
        postalCode="postalCode",
        line="line",
    )


@detail("Patient")
def patient_telecom(rows: DataFrame) -> DataFrame:
    contacts = per_element(rows, "contact", "data.telecom", patient_id="data.id")
    return shape(
        contacts,
        patient_id="patient_id",
        system="contact.system",
        value="contact.value",
        use="contact.use",
        okay_to_leave_message=first_of("contact.extension")["valueBoolean"],
    )


@detail("Patient")
def patient_extension(rows: DataFrame) -> DataFrame:
    extras = per_element(rows, "extra", "data.extension", patient_id="data.id")
    return shape(extras, patient_id="patient_id", type=url_tail("extra.url"), value=best_value("extra"))
