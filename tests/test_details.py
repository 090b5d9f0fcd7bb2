from __future__ import annotations

from chartweave.plans.details import DETAILS, build, detail_tables, resource_types, tables_of
from conftest import rows


def coding(code, display):
    return {"code": code, "display": display, "system": "s"}


def test_registry_covers_ten_types_and_thirty_tables():
    assert len(DETAILS) == 30
    assert len(resource_types()) == 10
    assert sorted(tables_of("Encounter")) == ["encounter", "encounter_reason", "encounter_type"]


def test_empty_resources_give_rows_only_where_nothing_is_exploded(records):
    bronze = records(*[{"resourceType": kind, "id": "x"} for kind in resource_types()])
    counts = {name: df.count() for name, df in detail_tables(bronze).items()}
    expected = {"patient", "observation", "observation_result", "medication_request", "dispense_request", "procedure"}
    assert {name for name, n in counts.items() if n} == expected


def test_patient_tables(records):
    bronze = records(
        {
            "resourceType": "Patient",
            "id": "p1",
            "multipleBirthInteger": 3,
            "maritalStatus": {"coding": []},
            "name": [
                {"use": "official", "family": "F", "given": ["a", "b"], "prefix": ["Dr."], "suffix": ["PhD", "MD"]},
                {"use": "old", "family": "G", "given": ["c"], "prefix": ["Dr."]},
            ],
            "telecom": [{"system": "phone", "value": "1", "extension": []}],
            "address": [
                {
                    "line": [],
                    "city": "C",
                    "extension": [
                        {"extension": [{"url": "latitude", "valueDecimal": 1.5}, {"url": "longitude", "valueDecimal": -2.5}]}
                    ],
                },
                {"city": "D", "extension": [{"extension": [{"url": "latitude", "valueDecimal": 1.5}]}]},
                {"city": "E"},
            ],
            "extension": [
                {"url": "http://x/race", "valueCodeableConcept": {"coding": [coding("1", "A"), coding("2", "B")]}, "valueCode": "no"},
                {"url": "http://x/place", "valueAddress": {"city": "C"}},
                {"url": "http://x/sex", "valueCode": "F", "valueString": "no"},
                {"url": "http://x/maiden", "valueString": "M"},
                {"url": "http://x/none/"},
            ],
        }
    )
    assert rows(build("patient", bronze), "patient_id", "multipleBirth", "maritalStatus") == [("p1", 3, None)]
    assert rows(build("patient_name", bronze), "given", "prefix", "suffix") == [
        (g, "Dr.", s) for g in "ab" for s in ("MD", "PhD")
    ]
    assert rows(build("patient_telecom", bronze), "value", "okay_to_leave_message") == [("1", None)]
    assert rows(build("patient_address", bronze), "city", "latitude", "longitude", "line") == [("C", 1.5, -2.5, None)]
    assert rows(build("patient_extension", bronze), "type", "value") == [
        ("", None), ("maiden", "M"), ("place", "C"), ("race", "A,B"), ("sex", "F"),
    ]


def test_observation_results_of_all_three_kinds(records):
    bronze = records(
        {"resourceType": "Observation", "id": "o1", "code": {"coding": [coding("k", "K")]}, "valueQuantity": {"value": 1.5, "unit": "kg"}},
        {
            "resourceType": "Observation",
            "id": "o2",
            "code": {"coding": [coding("bp", "BP")]},
            "component": [
                {"code": {"coding": [coding("s", "S"), coding("s2", "S2")]}, "valueQuantity": {"value": 120, "unit": "mm"}},
                {"code": {"coding": [coding("d", "D")]}},
                {"valueQuantity": {"value": 1, "unit": "mm"}},
            ],
        },
        {"resourceType": "Observation", "id": "o3", "valueCodeableConcept": {"coding": [coding("v", "V")]}},
    )
    assert rows(build("observation_result", bronze), "observation_id", "value", "unit", "code") == [
        ("o1", "1.5", "kg", "k"),
        ("o2", "120.0", "mm", "s"),
        ("o2", "120.0", "mm", "s2"),
        ("o2", None, None, "bp"),
        ("o2", None, None, "d"),
        ("o3", "V", "concept", "v"),
        ("o3", None, None, None),
    ]
    assert rows(build("observation_code", bronze), "code") == [("bp",), ("d",), ("k",), ("s",), ("s2",)]


def test_medication_tables(records):
    def request(**more):
        base = {"resourceType": "MedicationRequest", "context": {"reference": "urn:uuid:e1"}}
        return {**base, "medicationCodeableConcept": {"coding": [coding("m", "Med")]}, **more}

    note = {"coding": [coding("i1", "one"), coding("i2", "two")]}
    bronze = records(
        request(
            reasonReference='[{"reference": "urn:uuid:c1"}, {"reference": "urn:uuid:c2"}]',
            dosageInstruction=[
                {"sequence": 1, "asNeededBoolean": False, "additionalInstructions": [note, {"coding": [coding("i3", "three")]}]},
                {"sequence": 2},
            ],
        ),
        request(medicationCodeableConcept={"coding": []}, dosageInstruction=[{"asNeededBoolean": True}]),
        request(dosageInstruction=[]),
        request(),
    )
    assert rows(build("medication_request", bronze), "medication_request_id", "reasonReference", "medication_class") == [
        ("e1", None, "as needed"),
        ("e1_m", "c1", "scheduled"),
        ("e1_m", None, "no instructions"),
        ("e1_m", None, "scheduled"),
    ]
    assert rows(build("additional_instruction", bronze), "code") == [("i1",), ("i2",), ("i3",)]
    assert rows(build("dosage_instruction", bronze), "sequence", "additionalInstructionsCode") == [
        (1, "i1"), (2, None), (None, None),
    ]
    assert rows(build("medication", bronze), "code", "display") == [("m", "Med")]


def test_encounters_procedures_and_plans(records):
    bronze = records(
        {
            "resourceType": "Encounter",
            "id": "e1",
            "type": '[{"coding": [{"code": "t1"}], "text": "first"}, {"coding": [], "text": "second"}]',
            "reason": {"coding": [coding("r", "R")]},
        },
        {"resourceType": "Encounter", "id": "e2", "type": "not json"},
        {"resourceType": "Procedure", "reasonReference": '{"reference": "urn:uuid:c9"}', "performedDateTime": "t", "performedPeriod": {"end": "u"}},
        {
            "resourceType": "CarePlan",
            "category": ['{"coding": [{"code": "c1", "display": "C1"}]}', '{"coding": [{"code": "c2"}]}'],
            "activity": [{"detail": {"status": "s", "code": {"coding": [coding("a", "A")]}}}, {"detail": {}}],
            "addresses": [{"reference": "urn:uuid:x"}, {"reference": "urn:uuid:y"}],
        },
    )
    assert rows(build("encounter", bronze), "encounter_id", "type_code", "reason_code") == [("e1", "t1", "r"), ("e1", None, "r")]
    assert rows(build("encounter_type", bronze), "code", "display") == [("t1", "first"), (None, "second")]
    assert rows(build("encounter_reason", bronze), "code") == [("r",), ("r",)]
    assert rows(build("procedure", bronze), "reasonReference", "performedPeriodStart", "performedPeriodEnd") == [("c9", "t", "u")]
    assert rows(build("careplan", bronze), "address_id", "activityCode", "categoryCode") == [
        ("x", "a", "c1"), ("x", None, "c1"), ("y", "a", "c1"), ("y", None, "c1"),
    ]
    assert len(rows(build("careplan_category", bronze))) == 8
    assert len(rows(build("careplan_activity", bronze))) == 4


def test_codes_cross_their_lists(records):
    two = {"coding": [coding("k1", "K1"), coding("k2", "K2")]}
    bronze = records(
        {"resourceType": "DiagnosticReport", "id": "d", "code": two, "result": [{"reference": "urn:uuid:1"}, {"reference": "2"}]},
        {"resourceType": "DiagnosticReport", "id": "none", "code": two, "result": []},
        {"resourceType": "AllergyIntolerance", "code": two, "category": ["food", "other"], "type": "allergy"},
        {"resourceType": "Immunization", "vaccineCode": two, "date": "2012-01-01"},
        {"resourceType": "Condition", "id": "c", "code": {"coding": [coding("q", "Gout"), {"code": "z"}]}},
    )
    assert rows(build("diagnostic_result", bronze), "diagnostic_id", "result_id") == [("d", "1"), ("d", "1"), ("d", "2"), ("d", "2")]
    assert rows(build("diagnostic", bronze), "report_code") == [("k1",), ("k1",), ("k2",), ("k2",)]
    assert rows(build("allergy", bronze), "allergy_code") == [("k1",), ("k1",), ("k2",), ("k2",)]
    assert rows(build("allergy_code", bronze), "code", "category") == [("k1", "food"), ("k2", "food")]
    assert rows(build("immunization", bronze), "vaccineCode") == [("k1",), ("k2",)]
    assert rows(build("condition_code", bronze), "code", "category") == [("q", "Rheumatology"), ("z", "Other")]
