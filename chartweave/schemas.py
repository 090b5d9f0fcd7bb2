"""Fixed schemas of the nested input, so that no read needs an inference pass.

Fields that have a different shape in different resource types (``type``, ``reasonReference`` and the
elements of ``category``) are kept as text; the JSON reader stores the raw JSON of an object or array there.
"""

from __future__ import annotations

CODING = "ARRAY<STRUCT<code: STRING, display: STRING, system: STRING>>"
CONCEPT = f"STRUCT<coding: {CODING}>"
TEXT_CONCEPT = f"STRUCT<coding: {CODING}, text: STRING>"
REFERENCE = "STRUCT<reference: STRING>"
PERIOD = "STRUCT<start: STRING, `end`: STRING>"
QUANTITY = "STRUCT<value: DOUBLE, unit: STRING>"

RESOURCE_FIELDS = {
    "resourceType": "STRING",
    "id": "STRING",
    "status": "STRING",
    "gender": "STRING",
    "birthDate": "STRING",
    "deceasedDateTime": "STRING",
    "multipleBirthBoolean": "BOOLEAN",
    "multipleBirthInteger": "BIGINT",
    "maritalStatus": CONCEPT,
    "extension": f"ARRAY<STRUCT<url: STRING, valueCodeableConcept: {CONCEPT}, "
    "valueAddress: STRUCT<city: STRING, state: STRING>, valueCode: STRING, valueString: STRING>>",
    "address": "ARRAY<STRUCT<line: ARRAY<STRING>, city: STRING, state: STRING, postalCode: STRING, "
    "extension: ARRAY<STRUCT<url: STRING, extension: ARRAY<STRUCT<url: STRING, valueDecimal: DOUBLE>>>>>>",
    "telecom": "ARRAY<STRUCT<system: STRING, value: STRING, use: STRING, "
    "extension: ARRAY<STRUCT<url: STRING, valueBoolean: BOOLEAN>>>>",
    "name": "ARRAY<STRUCT<use: STRING, family: STRING, given: ARRAY<STRING>, prefix: ARRAY<STRING>, "
    "suffix: ARRAY<STRING>>>",
    "identifier": "ARRAY<STRUCT<system: STRING, value: STRING>>",
    "patient": REFERENCE,
    "subject": REFERENCE,
    "context": REFERENCE,
    "encounter": REFERENCE,
    "class": "STRUCT<code: STRING>",
    "type": "STRING",
    "category": "ARRAY<STRING>",
    "reason": CONCEPT,
    "reasonReference": "STRING",
    "period": PERIOD,
    "code": TEXT_CONCEPT,
    "clinicalStatus": "STRING",
    "verificationStatus": "STRING",
    "onsetDateTime": "STRING",
    "abatementDateTime": "STRING",
    "issued": "STRING",
    "effectiveDateTime": "STRING",
    "valueQuantity": QUANTITY,
    "valueCodeableConcept": CONCEPT,
    "component": f"ARRAY<STRUCT<code: {CONCEPT}, valueQuantity: {QUANTITY}>>",
    "medicationCodeableConcept": CONCEPT,
    "dateWritten": "STRING",
    "dosageInstruction": "ARRAY<STRUCT<sequence: BIGINT, asNeededBoolean: BOOLEAN, "
    "timing: STRUCT<repeat: STRUCT<frequency: BIGINT, period: DOUBLE, periodUnit: STRING>>, "
    f"doseQuantity: STRUCT<value: DOUBLE>, additionalInstructions: ARRAY<{CONCEPT}>>>",
    "dispenseRequest": f"STRUCT<numberOfRepeatsAllowed: BIGINT, quantity: {QUANTITY}, "
    f"expectedSupplyDuration: {QUANTITY}>",
    "vaccineCode": CONCEPT,
    "date": "STRING",
    "wasNotGiven": "BOOLEAN",
    "primarySource": "BOOLEAN",
    "performedPeriod": PERIOD,
    "performedDateTime": "STRING",
    "activity": f"ARRAY<STRUCT<detail: STRUCT<status: STRING, code: {CONCEPT}>>>",
    "addresses": f"ARRAY<{REFERENCE}>",
    "result": "ARRAY<STRUCT<reference: STRING, display: STRING>>",
    "criticality": "STRING",
    "assertedDate": "STRING",
}

RESOURCE_DDL = "STRUCT<" + ", ".join(f"`{name}`: {kind}" for name, kind in RESOURCE_FIELDS.items()) + ">"
BUNDLE_DDL = f"entry ARRAY<STRUCT<fullUrl: STRING, resource: {RESOURCE_DDL}>>"
BRONZE_DDL = f"batch_id INT, resource_type STRING, data {RESOURCE_DDL}"
LEDGER_DDL = "batch_id INT, save_ts TIMESTAMP, source STRING"

# Shapes of the fields that arrive as text.
REFERENCE_LIST = f"ARRAY<{REFERENCE}>"
CONCEPT_LIST = f"ARRAY<{TEXT_CONCEPT}>"

