"""Clinical records derived from the given tables, one bronze row per table row.

Every function is a plain projection (patients also look up nation and region), so the work of a query
grows with the table it reads.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartweave.schemas import RESOURCE_FIELDS

BATCHES = 3
#: more than any table has
ALL_PARTITIONS = 1_000_000


class Tables:
    """The given tables by attribute; each access is a lazy scan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def record_struct(fields: dict[str, str]) -> Column:
    """The full record shape; fields not given are NULL."""
    values = [f"'{name}', {fields.get(name) or f'CAST(NULL AS {ddl})'}" for name, ddl in RESOURCE_FIELDS.items()]
    return F.expr(f"named_struct({', '.join(values)})")


def record(rows: DataFrame, kind: str, batch: str, **fields: str) -> DataFrame:
    """``(batch_id, resource_type, data)`` rows of one resource type.

    The fields are columns before they are put together: of a struct with two computed fields in use, Spark builds
    all fields for every row. The coalesce, to more partitions than there are, moves no row. It only keeps the two
    projections apart, so a plan computes the fields it uses, each once, as a scan of stored records reads them.
    """
    named = {name: f"`{name}`" for name in fields}
    columns = rows.select(
        F.expr(f"CAST({batch} % {BATCHES} AS INT)").alias("batch_id"),
        *[F.expr(value).alias(name) for name, value in fields.items()],
    )
    return columns.coalesce(ALL_PARTITIONS).select(
        "batch_id", F.lit(kind).alias("resource_type"), record_struct(named).alias("data")
    )


def coding(code: str, display: str) -> str:
    return f"named_struct('code', {code}, 'display', {display}, 'system', 'http://example.org/codes')"


def concept(*codings: str) -> str:
    return f"named_struct('coding', array({', '.join(codings)}))"


def text_concept(one: str, text: str) -> str:
    return f"named_struct('coding', array({one}), 'text', {text})"


def ref(identifier: str) -> str:
    return f"named_struct('reference', concat('urn:uuid:', {identifier}))"


def moment(ts: str) -> str:
    return f"concat(date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss\"), '-04:00')"


def quantity(value: str, unit: str) -> str:
    return f"named_struct('value', CAST({value} AS DOUBLE), 'unit', {unit})"


def missing_when(condition: str, value: str) -> str:
    return f"IF({condition}, NULL, {value})"


def patients(t: Tables) -> DataFrame:
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    url = "'http://example.org/fhir/{}'"

    def extra(name: str, concept_="NULL", place="NULL", code="NULL", text="NULL") -> str:
        kinds = RESOURCE_FIELDS["maritalStatus"]
        return (
            f"named_struct('url', {url.format(name)}, 'valueCodeableConcept', CAST({concept_} AS {kinds}), "
            f"'valueAddress', CAST({place} AS STRUCT<city: STRING, state: STRING>), "
            f"'valueCode', CAST({code} AS STRING), 'valueString', CAST({text} AS STRING))"
        )

    def coordinate(name: str, value: str) -> str:
        return f"named_struct('url', '{name}', 'valueDecimal', CAST({value} AS DOUBLE))"

    latitude = coordinate("latitude", "c_nationkey + 0.5")
    longitude = coordinate("longitude", "-(c_nationkey + 0.25)")
    name = "concat('Given-', c_custkey)"
    return record(
        people,
        "Patient",
        "c_custkey",
        resourceType="'Patient'",
        id="concat('pat-', c_custkey)",
        gender="IF(c_custkey % 2 = 0, 'male', 'female')",
        birthDate="date_format(date_add(DATE'1940-01-01', CAST(c_custkey % 25000 AS INT)), 'yyyy-MM-dd')",
        deceasedDateTime="IF(c_custkey % 9 = 0, concat(date_format(date_add(DATE'2010-01-01', "
        "CAST(c_custkey % 3000 AS INT)), 'yyyy-MM-dd'), 'T08:30:00-04:00'), NULL)",
        multipleBirthBoolean=missing_when("c_custkey % 10 = 0", "c_custkey % 3 = 0"),
        multipleBirthInteger="IF(c_custkey % 10 = 0, c_custkey % 4 + 1, NULL)",
        maritalStatus=missing_when(
            "c_custkey % 7 = 0", concept(coding("substring(c_mktsegment, 1, 1)", "c_mktsegment"))
        ),
        extension="array("
        + ", ".join(
            [
                extra("us-core-race", concept_=concept(coding("'R1'", "c_mktsegment"), coding("'R2'", "r_name"))),
                extra("birthPlace", place="named_struct('city', n_name, 'state', r_name)"),
                extra("us-core-birthsex", code="IF(c_custkey % 2 = 0, 'M', 'F')"),
                extra("mothersMaidenName", text="concat('Maiden-', c_custkey % 100)"),
            ]
        )
        + ")",
        address="array(named_struct('line', array(c_name, 'Unit 1'), 'city', n_name, 'state', r_name, "
        "'postalCode', lpad(CAST(c_custkey % 100000 AS STRING), 5, '0'), 'extension', "
        "array(named_struct('url', 'http://example.org/fhir/geolocation', 'extension', "
        f"IF(c_custkey % 11 = 0, array({latitude}), array({latitude}, {longitude}))))))",
        telecom="IF(c_custkey % 13 = 0, slice(array(named_struct('system', 'phone', 'value', '', 'use', 'home', "
        "'extension', array(named_struct('url', '', 'valueBoolean', true)))), 1, 0), "
        "array(named_struct('system', 'phone', 'value', concat('555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')), "
        "'use', IF(c_custkey % 2 = 0, 'home', 'mobile'), 'extension', "
        "filter(array(named_struct('url', 'http://example.org/fhir/okayToLeaveMessage', 'valueBoolean', "
        "c_custkey % 4 = 0)), x -> c_custkey % 6 <> 0))))",
        name=f"array(named_struct('use', 'official', 'family', c_name, 'given', "
        f"IF(c_custkey % 2 = 0, array(concat({name}, 'a'), concat({name}, 'b')), array(concat({name}, 'a'))), "
        "'prefix', array(IF(c_custkey % 2 = 0, 'Mr.', 'Ms.')), "
        "'suffix', IF(c_custkey % 5 = 0, array('Jr.', 'MD'), NULL)))",
        identifier="array(named_struct('system', 'http://example.org/id/mrn', 'value', CAST(c_custkey AS STRING)), "
        "named_struct('system', 'http://example.org/id/ssn', 'value', concat('999-', c_custkey)))",
    )


def encounter_fields() -> dict[str, str]:
    first = text_concept(
        coding("substring(o_orderpriority, 1, 1)", "o_orderpriority"), "concat(o_orderpriority, ' b', o_orderkey % 3)"
    )
    second = text_concept(coding("'F'", "'follow-up'"), "'Follow-up visit'")
    return dict(
        resourceType="'Encounter'",
        id="concat('enc-', o_orderkey)",
        status="o_orderstatus",
        patient=ref("concat('pat-', o_custkey)"),
        **{
            "class": "named_struct('code', CASE o_orderkey % 3 WHEN 0 THEN 'ambulatory' "
            "WHEN 1 THEN 'emergency' ELSE 'inpatient' END)"
        },
        type=f"to_json(IF(o_orderkey % 6 = 0, array({first}, {second}), array({first})))",
        reason=missing_when(
            "o_orderkey % 4 = 0",
            concept(coding("concat('R', o_orderkey % 5)", "concat('Reason ', o_orderkey % 5, ' b', o_orderkey % 3)")),
        ),
        period=f"named_struct('start', {moment('o_orderdate')}, 'end', {moment('o_orderdate + INTERVAL 1 HOUR')})",
    )


def encounters(t: Tables) -> DataFrame:
    return record(t.orders, "Encounter", "o_orderkey", **encounter_fields())


def conditions(t: Tables) -> DataFrame:
    display = (
        "CASE event_type WHEN 'error' THEN 'Concussion injury' WHEN 'click' THEN 'Hypertension' "
        "WHEN 'signup' THEN 'Childhood asthma' "
        "WHEN 'view' THEN IF(event_id % 3 = 2, 'Fracture of wrist', 'Diabetes') "
        "ELSE IF(event_id % 2 = 0, 'Otitis media', 'Acute rhinitis') END"
    )
    return record(
        t.events,
        "Condition",
        "event_id",
        resourceType="'Condition'",
        id="concat('cond-', event_id)",
        code=text_concept(coding("event_type", display), display),
        clinicalStatus="IF(event_id % 3 = 0, 'active', 'resolved')",
        verificationStatus="'confirmed'",
        onsetDateTime=moment("ts"),
        abatementDateTime=missing_when("event_id % 3 = 0", moment("ts + INTERVAL 1 DAY")),
        subject=ref("concat('pat-', user_id)"),
        context=ref("concat('enc-', event_id)"),
    )


def observations(t: Tables) -> DataFrame:
    def part(code: str, value: str) -> str:
        return (
            f"named_struct('code', {concept(coding(f'{chr(39)}{code}{chr(39)}', f'{chr(39)}{code} pressure{chr(39)}'))}, "
            f"'valueQuantity', {quantity(value, chr(39) + 'mmHg' + chr(39))})"
        )

    return record(
        t.lineitem,
        "Observation",
        "l_partkey",
        resourceType="'Observation'",
        id="concat('obs-', l_orderkey, '-', l_linenumber)",
        status="IF(l_linestatus = 'O', 'preliminary', 'final')",
        code=text_concept(
            coding("concat('LN', l_linenumber)", "concat('Line ', l_linenumber, ' b', l_partkey % 3)"),
            "concat('Line ', l_linenumber)",
        ),
        subject=ref("concat('pat-', l_suppkey)"),
        encounter=ref("concat('enc-', l_orderkey)"),
        issued=moment("l_shipdate"),
        effectiveDateTime=moment("l_shipdate - INTERVAL 1 DAY"),
        valueQuantity=f"IF(l_linenumber % 3 = 1, {quantity('l_quantity', chr(39) + 'kg' + chr(39))}, NULL)",
        valueCodeableConcept=f"IF(l_linenumber % 3 = 2, {concept(coding('l_linestatus', 'l_returnflag'))}, NULL)",
        component=f"IF(l_linenumber % 3 = 0, array({part('systolic', 'l_quantity')}, "
        f"{part('diastolic', 'l_tax')}), NULL)",
    )


def medication_requests(t: Tables) -> DataFrame:
    def note(code: str, display: str) -> str:
        return concept(coding(f"'{code}'", f"'{display}'"))

    def dose(sequence: str, as_needed: str, repeat: str, amount: str, notes: str) -> str:
        return (
            f"named_struct('sequence', CAST({sequence} AS BIGINT), 'asNeededBoolean', {as_needed}, 'timing', {repeat}, "
            f"'doseQuantity', {amount}, 'additionalInstructions', {notes})"
        )

    timed = (
        "named_struct('repeat', named_struct('frequency', CAST(l_linenumber AS BIGINT), 'period', CAST(1 AS DOUBLE), "
        "'periodUnit', 'd'))"
    )
    untimed = f"IF(true, NULL, {timed})"
    amount = "named_struct('value', CAST(l_quantity / 2 AS DOUBLE))"
    no_amount = f"IF(true, NULL, {amount})"
    notes = (
        f"IF(l_linenumber = 7, array({note('I1', 'Take with food')}, {note('I2', 'Do not crush')}), "
        f"array({note('I1', 'Take with food')}))"
    )
    no_notes = f"IF(true, NULL, {notes})"
    needed = dose("1", "true", untimed, no_amount, no_notes)
    first, second = dose("1", "false", timed, amount, notes), dose("2", "false", timed, no_amount, no_notes)
    return record(
        t.lineitem,
        "MedicationRequest",
        "l_partkey",
        resourceType="'MedicationRequest'",
        id="concat('med-', l_orderkey, '-', l_linenumber)",
        status="IF(l_linestatus = 'O', 'active', 'completed')",
        context=ref("concat('enc-', l_orderkey)"),
        patient=ref("concat('pat-', l_suppkey)"),
        medicationCodeableConcept=concept(coding("concat('M', l_partkey)", "concat('Drug ', l_partkey)")),
        dateWritten=moment("l_shipdate"),
        reasonReference="IF(l_partkey % 2 = 0, to_json(array(named_struct('reference', "
        "concat('urn:uuid:cond-', l_orderkey)))), NULL)",
        dosageInstruction=f"CASE l_linenumber % 4 WHEN 0 THEN slice(array({first}), 1, 0) WHEN 1 THEN NULL "
        f"WHEN 2 THEN array({needed}) ELSE IF(l_linenumber = 7, array({first}, {second}), array({first})) END",
        dispenseRequest=missing_when(
            "l_linenumber % 4 = 1",
            "named_struct('numberOfRepeatsAllowed', CAST(l_linenumber AS BIGINT), 'quantity', "
            + quantity("l_quantity", "'tablet'")
            + ", 'expectedSupplyDuration', "
            + quantity("l_quantity * 2", "'d'")
            + ")",
        ),
    )


def immunizations(t: Tables) -> DataFrame:
    return record(
        t.events,
        "Immunization",
        "event_id",
        resourceType="'Immunization'",
        id="concat('imm-', event_id)",
        status="'completed'",
        patient=ref("concat('pat-', user_id)"),
        encounter=ref("concat('enc-', event_id)"),
        vaccineCode=concept(
            coding("concat('V', event_id % 12)", "concat('Vaccine ', event_id % 12, ' b', event_id % 3)")
        ),
        date=moment("ts"),
        wasNotGiven="event_id % 5 = 0",
        primarySource="event_id % 2 = 0",
    )


def procedure_fields() -> dict[str, str]:
    return dict(
        resourceType="'Procedure'",
        id="concat('proc-', o_orderkey)",
        status="'completed'",
        subject=ref("concat('pat-', o_custkey)"),
        encounter=ref("concat('enc-', o_orderkey)"),
        reasonReference="IF(o_orderkey % 3 = 0, to_json(named_struct('reference', "
        "concat('urn:uuid:cond-', o_orderkey))), NULL)",
        code=text_concept(
            coding("concat('P', o_orderkey % 20)", "concat('Procedure ', o_orderkey % 20, ' b', o_orderkey % 3)"),
            "concat('Procedure ', o_orderkey % 20)",
        ),
        performedPeriod=f"IF(o_orderkey % 2 = 0, named_struct('start', {moment('o_orderdate')}, "
        f"'end', {moment('o_orderdate + INTERVAL 2 HOUR')}), NULL)",
        performedDateTime=f"IF(o_orderkey % 2 = 1, {moment('o_orderdate')}, NULL)",
    )


def procedures(t: Tables) -> DataFrame:
    return record(t.orders, "Procedure", "o_orderkey", **procedure_fields())


def careplans(t: Tables) -> DataFrame:
    activity = (
        "named_struct('detail', named_struct('status', IF((c_custkey + i) % 2 = 0, 'in-progress', 'completed'), 'code', "
        + concept(coding("concat('A', (c_custkey + i) % 10)", "concat('Activity ', (c_custkey + i) % 10)"))
        + "))"
    )
    category = concept(coding("concat('C', c_custkey % 4)", "concat('Category ', c_custkey % 4, ' b', c_custkey % 3)"))
    start = "date_format(date_add(DATE'2015-01-01', CAST(c_custkey % 1000 AS INT)), 'yyyy-MM-dd')"
    return record(
        t.customer,
        "CarePlan",
        "c_custkey",
        resourceType="'CarePlan'",
        id="concat('plan-', c_custkey)",
        status="IF(c_custkey % 2 = 0, 'active', 'completed')",
        subject=ref("concat('pat-', c_custkey)"),
        context=ref("concat('enc-', c_custkey)"),
        category=f"array(to_json({category}))",
        period=f"named_struct('start', concat({start}, 'T09:00:00-04:00'), "
        f"'end', IF(c_custkey % 2 = 0, NULL, {start}))",
        activity=f"transform(slice(array(1, 2), 1, CAST(c_custkey % 3 AS INT)), i -> {activity})",
        addresses="transform(slice(array(1, 2), 1, CAST(1 + c_custkey % 2 AS INT)), "
        "i -> named_struct('reference', concat('urn:uuid:cond-', c_custkey * 10 + i)))",
    )


def diagnostic_reports(t: Tables) -> DataFrame:
    return record(
        t.orders,
        "DiagnosticReport",
        "o_orderkey",
        resourceType="'DiagnosticReport'",
        id="concat('rep-', o_orderkey)",
        status="IF(o_orderstatus = 'F', 'final', 'registered')",
        subject=ref("concat('pat-', o_custkey)"),
        encounter=ref("concat('enc-', o_orderkey)"),
        code=text_concept(
            coding("concat('D', o_orderkey % 8)", "concat('Panel ', o_orderkey % 8, ' b', o_orderkey % 3)"),
            "concat('Panel ', o_orderkey % 8)",
        ),
        issued=moment("o_orderdate"),
        effectiveDateTime=missing_when("o_orderkey % 10 = 0", moment("o_orderdate - INTERVAL 3 HOUR")),
        result="transform(slice(array(1, 2, 3), 1, CAST(o_orderkey % 4 AS INT)), i -> named_struct('reference', "
        "concat('urn:uuid:obs-', o_orderkey, '-', i), 'display', concat('Line ', i)))",
    )


def allergies(t: Tables) -> DataFrame:
    return record(
        t.supplier,
        "AllergyIntolerance",
        "s_suppkey",
        resourceType="'AllergyIntolerance'",
        id="concat('alg-', s_suppkey)",
        type="IF(s_suppkey % 3 = 0, 'intolerance', 'allergy')",
        category="IF(s_suppkey % 2 = 0, array('food', 'environment'), array('food'))",
        criticality="IF(s_suppkey % 4 = 0, 'high', 'low')",
        patient=ref("concat('pat-', s_suppkey)"),
        clinicalStatus="'active'",
        assertedDate="concat(date_format(date_add(DATE'2000-01-01', CAST(s_suppkey % 900 AS INT)), 'yyyy-MM-dd'), "
        "'T10:00:00-04:00')",
        code=text_concept(
            coding("concat('AL', s_suppkey % 15)", "concat('Allergen ', s_suppkey % 15)"),
            "concat('Allergen ', s_suppkey % 15)",
        ),
    )


RECORDS = {
    "Patient": patients,
    "Encounter": encounters,
    "Condition": conditions,
    "Observation": observations,
    "MedicationRequest": medication_requests,
    "Immunization": immunizations,
    "Procedure": procedures,
    "CarePlan": careplans,
    "DiagnosticReport": diagnostic_reports,
    "AllergyIntolerance": allergies,
}


def bronze(t: Tables, *kinds: str) -> DataFrame:
    """All records of the named types (default: of every type) as one frame."""
    return reduce(DataFrame.unionByName, [RECORDS[kind](t) for kind in kinds or RECORDS])


def bundles(t: Tables) -> DataFrame:
    """Bundle text, one per order: its encounter and its procedure."""

    def entry(fields: dict[str, str]) -> Column:
        resource = record_struct(fields)
        return F.struct(F.concat(F.lit("urn:uuid:"), resource["id"]).alias("fullUrl"), resource.alias("resource"))

    entries = F.array(entry(encounter_fields()), entry(procedure_fields()))
    return t.orders.select(F.to_json(F.struct(entries.alias("entry"))).alias("value"))


def image_files(t: Tables) -> DataFrame:
    """``(path, content)``: one small image file per part; every tenth is not readable."""

    def element(tag: str, kind: str, value: str) -> str:
        padded = f"IF(length({value}) % 2 = 1, concat({value}, ' '), {value})"
        return (
            f"concat(unhex('{tag}'), CAST('{kind}' AS BINARY), unhex(lpad(hex(length({padded})), 2, '0')), "
            f"unhex('00'), CAST({padded} AS BINARY))"
        )

    def number(tag: str, value: str) -> str:
        return f"concat(unhex('{tag}'), CAST('US' AS BINARY), unhex('0200'), unhex(lpad(hex({value}), 2, '0')), unhex('00'))"

    syntax = "'1.2.840.10008.1.2.1'"
    day = "date_format(date_add(DATE'2020-01-01', CAST(p_partkey % 30 AS INT)), 'yyyyMMdd')"
    empty = "unhex('')"
    parts = [
        "unhex(repeat('00', 128))",
        "CAST('DICM' AS BINARY)",
        element("02001000", "UI", syntax),
        element("08002000", "DA", day),
        element("08006000", "CS", "IF(p_size % 2 = 0, 'CT', 'MR')"),
        element("08003010", "LO", "p_type"),
        f"IF(p_partkey % 4 = 0, {empty}, {element('08003E10', 'LO', 'p_brand')})",
        element("10002000", "LO", "concat('pat-', p_partkey)"),
        number("28001000", "2"),
        number("28001100", "2"),
        number("28000001", "8"),
        number("28000301", "0"),
        "unhex('E07F10004F57000004000000'), unhex(lpad(hex(p_partkey % 256), 2, '0')), unhex('0001FF')",
    ]
    content = f"concat({', '.join(parts)})"
    return t.part.selectExpr(
        "concat('images/', p_partkey % 50, '/', p_partkey, '.dcm') AS path",
        f"IF(p_partkey % 10 = 9, CAST(concat('broken ', p_partkey) AS BINARY), {content}) AS content",
    )


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Each row's content as a file below the folder, written by the tasks; returns the paths."""

    def write(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                target = os.path.join(folder.removeprefix("file:"), path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(target, "wb") as out:
                    out.write(content)
            yield batch.select(["path"])

    return files.select("path", "content").mapInArrow(write, "path STRING")
