"""Provider resources on hand-written documents: defaults, ties, versions, slices."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks import histories
from millrace import session
from millrace.operators import flatten, versions
from millrace.plans import dimensions, history, resource_specs, resources
from millrace.sources import keyed, ndjson

RAW = (
    "file_name string, file_row_number bigint, file_content_key string, file_last_modified timestamp, "
    "start_scan_time timestamp, file_resource_type string, file_record_id string, file_content_raw string, load_dt date"
)


def raw_row(doc, *, export="Exp", bundle="B", modified=1, slice_day=1, record=None):
    moment = dt.datetime(2024, 1, modified)
    return (
        f"FHIR/in/{export}/d/{bundle}/f.ndjson", 1, "k", moment, moment, doc["resourceType"],
        record or doc["id"], json.dumps(doc), dt.date(2024, 1, slice_day),
    )


def raw_of(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def flat(spark, doc_or_rows, kind):
    rows = doc_or_rows if isinstance(doc_or_rows, list) else [raw_row(doc_or_rows)]
    return resources.flatten_resource(raw_of(spark, *rows), resource_specs.RESOURCES[kind]).collect()


def ref(value):
    return {"reference": value}


def test_empty_documents_get_the_defaults(spark):
    person = flat(spark, {"id": "p-1", "resourceType": "Practitioner"}, "Practitioner")[0]
    assert person["plan_prov_id"] == "" and person["taxonomy_cd"] == ""
    assert person["prov_last_name"] is None and person["prov_credential"] is None
    assert person["board_certification_ind"] == ":" and person["communication"] == ""
    place = flat(spark, {"id": "l-1", "resourceType": "Location"}, "Location")[0]
    assert place["prov_communication_info_phone"] == " "
    assert place["provider_location_master_identifier"] == "" and place["service_area_cd"] is None
    assert place["days_of_week_and_office_hours"] == "\n".join([" "] * 7)
    org = flat(spark, {"id": "o-1", "resourceType": "Organization"}, "Organization")
    assert len(org) == 1 and org[0]["network_ref_record_id"] == "" and org[0]["plan_prov_id"] is None
    assert org[0]["prov_tax_id"] == "" and org[0]["prov_addr_use"] is None


def test_person_and_organization_tax_codes_differ(spark):
    ident = [{"value": "9", "type": {"coding": [{"code": "EN"}]}}]
    assert flat(spark, {"id": "p", "resourceType": "Practitioner", "identifier": ident}, "Practitioner")[0]["prov_tax_id"] == "9"
    org = flat(spark, {"id": "o", "resourceType": "Organization", "identifier": ident}, "Organization")[0]
    assert org["prov_tax_id"] == "" and org["other_plan_prov_id"] == "9"


def test_taxonomy_text_keeps_its_line_break(spark):
    doc = {
        "id": "p",
        "resourceType": "Practitioner",
        "qualification": [{"code": {"coding": [{"system": "x/provider-taxonomy", "code": "1", "display": "a  b"}]}}],
    }
    row = flat(spark, doc, "Practitioner")[0]
    assert row["taxonomy_desc"] == "1:a b\n" and row["taxonomy_cd"] == "1"


def hours(n):
    return [{"daysOfWeek": ["d"], "availableStartTime": "8", "availableEndTime": "5"}] * n


@pytest.mark.parametrize("days,expected", [(4, None), (5, ",".join(["d:5-8"] * 5)), (6, ",".join(["d:5-8"] * 5))])
def test_office_hours_need_five_days(spark, days, expected):
    doc = {"id": "r", "resourceType": "PractitionerRole", "availableTime": hours(days)}
    assert flat(spark, doc, "PractitionerRole")[0]["days_of_week_and_office_hours"] == expected


def test_weekly_hours_vanish_when_a_slot_lacks_a_part(spark):
    doc = {"id": "l", "resourceType": "Location", "hoursOfOperation": [{"daysOfWeek": ["mon"], "openingTime": "8"}]}
    assert flat(spark, doc, "Location")[0]["days_of_week_and_office_hours"] is None


def test_affiliation_keeps_five_services_and_drops_documents_without(spark):
    many = {"id": "a", "resourceType": "OrganizationAffiliation", "healthcareService": [ref(f"h/{i}") for i in range(7)]}
    none = {"id": "b", "resourceType": "OrganizationAffiliation"}
    rows = flat(spark, [raw_row(many), raw_row(none)], "OrganizationAffiliation")
    assert sorted(r["healthcare_service_ref_record_id"] for r in rows) == ["0", "1", "2", "3", "4"]


def test_one_row_per_network(spark):
    def role(name, *networks):
        extension = [{"url": "x/networkreference", "valueReference": ref(f"N/{n}")} for n in networks]
        return raw_row({"id": name, "resourceType": "PractitionerRole", "extension": extension})

    rows = flat(spark, [role("zero"), role("one", "n1"), role("two", "n2", "n1", "n1")], "PractitionerRole")
    assert sorted((r["file_record_id"], r["network_ref_record_id"]) for r in rows) == [
        ("one", "n1"), ("two", "n1"), ("two", "n2"), ("zero", ""),
    ]


def test_latest_version_per_export_type_or_record(spark):
    def versioned(kind):
        doc = {"id": "x", "resourceType": kind}
        return [raw_row(doc, export="A", modified=5), raw_row(doc, export="B", modified=2), raw_row(doc, export="B", modified=1)]

    places = flat(spark, versioned("Location"), "Location")
    assert sorted(r["file_export_type"] for r in places) == ["A", "B"]
    assert [r["file_export_type"] for r in flat(spark, versioned("PractitionerRole"), "PractitionerRole")] == ["A"]


def test_documents_tied_on_their_time_merge(spark):
    one = {"id": "o", "resourceType": "Organization", "name": "b", "identifier": [{"value": "2", "type": {"coding": [{"code": "NPI"}]}}]}
    two = {"id": "o", "resourceType": "Organization", "name": "a", "identifier": [{"value": "1", "type": {"coding": [{"code": "NPI"}]}}]}
    rows = flat(spark, [raw_row(one), raw_row(two)], "Organization")
    assert len(rows) == 1
    assert rows[0]["prov_organization_name"] == "b" and rows[0]["national_prov_id_list"] == "1 2"


def role_doc(record, places, nets=(), **more):
    extension = [{"url": "http://x/networkreference", "valueReference": ref(f"Network/{n}")} for n in nets]
    return {
        "id": record, "resourceType": "PractitionerRole", "practitioner": ref("Practitioner/p"), "extension": extension,
        "location": [ref(f"Location/{p}") for p in places], **more,
    }


def test_documents_alone_give_the_rows_of_the_merge(spark):
    rows = [
        raw_row(role_doc("r1", ["a", "b", "a"], ["n2", "n1", "n2"])),
        raw_row(role_doc("r1", ["old"]), modified=1, record="r2"),
        raw_row(role_doc("r2", []), modified=2),
        raw_row(role_doc("r3", ["a"], ["n1"], period={"start": "1"}), modified=3),
        raw_row(role_doc("r3", ["a", "c"], ["n2"], period={"start": "2"}), modified=3),
    ]
    docs = resources.current_documents(raw_of(spark, *rows), resource_specs.PRACTITIONER_ROLE)
    assert {r.file_record_id: r.alone for r in docs.collect()} == {"r1": True, "r2": True, "r3": False}
    both = [
        sorted(map(str, resources.flatten_documents(d, resource_specs.PRACTITIONER_ROLE).collect()))
        for d in (docs, docs.drop("alone"))
    ]
    assert both[0] == both[1] and len(both[0]) == 2 * 2 + 1 + 3


def test_documents_alone_are_neither_sorted_nor_grouped(spark):
    docs = resources.current_documents(raw_of(spark, raw_row(role_doc("r", ["a"]))), resource_specs.PRACTITIONER_ROLE)
    rows = resources.flatten_documents(docs.where("alone"), resource_specs.PRACTITIONER_ROLE)
    rows = rows.where("prov_eff_dt is null").select("file_record_id", "prov_eff_dt", "value_based_program_id")
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    union = plan[plan.index("Union"):] if "Union" in plan else plan
    first = union.split("ObjectHashAggregate")[0]
    assert "ShuffledHashJoin" in first and "SortMergeJoin" not in plan


def test_every_repeated_key_is_compared(spark):
    """The bitmap knows each key that comes twice, whatever bit it falls on; single ones mostly stay where they are."""
    rows = spark.range(30000).selectExpr("concat('r', id) as k", "explode(if(id % 3 = 0, array(1, 2), array(1))) as clock")
    repeated = versions.has_bit(versions.repeated_keys(rows, ["k"]), ["k"])
    assert rows.where(repeated & (F.substring("k", 2, 9).cast("int") % 3 == 0)).count() == 20000
    assert rows.where(~repeated).count() > 19000
    newest = versions.latest_marked(rows, ["k"], "clock")
    assert newest.count() == 30000 and newest.where("clock = 2").count() == 10000 and newest.where("alone").count() == 30000


def test_lone_documents_are_not_moved(spark):
    rows = [raw_row(role_doc(f"r{n}", ["a"])) for n in range(200)] + [raw_row(role_doc("r0", ["b"]), modified=2)]
    docs = resources.current_documents(raw_of(spark, *rows), resource_specs.PRACTITIONER_ROLE)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "Join" in plan and "Join" not in plan[plan.index("\n+- ") :]  # only the compared ones meet others
    assert sorted(r.file_record_id for r in docs.collect()) == sorted(f"r{n}" for n in range(200))


def test_extensions_are_found_by_their_place_as_by_going_through_all(spark):
    """Repeated urls take the greatest value, a lone one without a value stays NULL, others give ''."""
    def inner(url, **more):
        return {"url": url, **more}

    def coded(*codes):
        return {"coding": [{"code": c} for c in codes]}

    details = [
        inner("provAffType", valueCodeableConcept=coded("a", "c")), inner("provAffType", valueCodeableConcept=coded("b")),
        inner("pcpEffectivePeriod", valuePeriod={"start": "1", "end": None}), inner("characteristics"),
        inner("provAffRef", valueReference={"reference": "Organization/h1"}), inner("provAffRef", valueReference={}),
    ]
    outer = [
        {"url": "http://x/licenseereference", "valueReference": ref("Licensee/2")},
        {"url": "http://y/licenseereference", "valueReference": ref("Licensee/1")},
        {"url": "http://x/provcontract", "valueBoolean": True},
        {"url": "http://x/details", "extension": details},
    ]
    doc = {"id": "r", "resourceType": "PractitionerRole", "extension": outer}
    alone = {**doc, "id": "s", "extension": [{"url": "http://x/details", "extension": [inner("characteristics")]}]}
    found = {r["file_record_id"]: r for r in flat(spark, [raw_row(doc), raw_row(alone)], "PractitionerRole")}
    one, two = found["r"], found["s"]
    assert (one["prov_affil_type"], one["pcp_eff_dt"], one["pcp_end_dt"]) == ("c", "1", "")
    assert (one["prov_affil_ref"], one["licensee_ref_record_id"], one["prov_contract_status"]) == ("h1", "2", "true")
    assert one["prov_patient_gender_limit"] == "" and two["prov_patient_gender_limit"] is None and two["prov_affil_type"] == ""


def test_documents_are_parsed_apart_from_their_making(spark):
    """A text that the query makes is made once, by compiled code: Spark does not draw it into the parser's arguments."""
    made = raw_of(spark, raw_row(role_doc("r", ["a"]))).withColumn("file_content_raw", F.to_json(F.struct(F.col("file_record_id").alias("id"))))
    rows = resources.flatten_resource(made, resource_specs.PRACTITIONER_ROLE)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "from_json" in line and "StructsToJson" in line]


def test_only_the_first_services_of_a_service_are_joined(spark):
    facts = spark.createDataFrame(
        [("r1", "E", "s1"), ("r1", "E", "s2"), ("r2", "E", "s1"), ("r2", "E", "s1"), ("r3", "E", None), ("r4", "F", "s1")],
        "file_record_id string, file_export_type string, healthcare_service_ref_record_id string",
    )
    rows = [("E", "s1", str(i), "x") for i in (6, 5, 4, 3, 3, 2)] + [("E", "s2", "9", "y"), ("E", "s2", None, "y"), ("E", "s0", "0", "z")]
    service = spark.createDataFrame(
        rows, "file_export_type string, file_record_id string, healthcare_service_type_cd string, healthcare_service_type string"
    )
    found = {r[0]: list(r[1:]) for r in history.provider_services(facts, service).collect()}
    assert found == {"r1": ["9:y", None, "2:x", "3:x"], "r2": ["2:x", "3:x", "3:x", "4:x"]}


def test_services_of_roles_store_no_documents(spark, tmp_path, monkeypatch):
    def refuse(*args):
        raise AssertionError("documents are stored")

    monkeypatch.setattr(ndjson, "write_raw", refuse)
    given = {
        "customer": "values (1L, 7), (2L, 8) as t(c_custkey, c_nationkey)",
        "orders": "values (5L, 1L, 'O', timestamp'2024-01-01', '1-URGENT'), (6L, 2L, 'F', timestamp'2024-01-01', '5-LOW') "
        "as t(o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority)",
        "part": "values (1L, 20, 'x', 'b', 'n'), (5L, 1, 'y', 'b', 'n') as t(p_partkey, p_size, p_type, p_brand, p_name)",
    }
    for name, rows in given.items():
        spark.sql(f"select * from {rows}").write.parquet(str(tmp_path / f"{name}.parquet"))
    found = {r[0]: list(r[1:]) for r in histories.provider_services(spark, str(tmp_path)).collect()}
    assert found == {"role5-role": ["t1:x 1", "t2:x 2", None, None]}


def test_an_empty_unfolded_array_is_seen_after_parsing(spark):
    parsed = spark.range(3).select("id", F.expr("slice(array(null, 7), 1, cast(id as int))").alias("one"))
    rows = flatten.flatten_parsed(parsed, "one")
    assert sorted((r.id, r.one) for r in rows.where("id < 2").collect()) == [(1, None)] and rows.count() == 3
    assert "size(" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_equal_measures_are_one_row_whatever_their_key_order(spark):
    first = {"url": "m", "extension": [{"url": "q/decile", "valueInteger": 3}]}
    again = {"extension": [{"valueInteger": 3, "url": "q/decile"}], "url": "m"}
    doc = {"id": "b", "resourceType": "Basic", "extension": [first, again, {"url": "n"}]}
    assert sorted(r["decile"] for r in flat(spark, doc, "Basic")) == ["", "3"]


def test_late_old_version_changes_nothing(spark):
    new = raw_row({"id": "l", "resourceType": "Location", "name": "new"}, modified=9, slice_day=1)
    old = raw_row({"id": "l", "resourceType": "Location", "name": "old"}, modified=2, slice_day=2)
    spec = resource_specs.LOCATION
    target, log = session.scratch_path(spark, "loc"), session.scratch_path(spark, "log")
    resources.load_resource(spark, raw_of(spark, new), spec, target, log, buckets=4)
    resources.load_resource(spark, raw_of(spark, new, old), spec, target, log, buckets=4)
    assert [r["prov_dba_name"] for r in keyed.read_keyed(spark, target).collect()] == ["new"]
    assert spark.read.parquet(log).count() == 2
    assert resources.load_resource(spark, raw_of(spark, new, old), spec, target, log, buckets=4).isEmpty()


def place(n, name, modified, day):
    return raw_row({"id": f"l{n}", "resourceType": "Location", "name": name}, modified=modified, slice_day=day)


@pytest.mark.parametrize("lost", ["merge", "replace", "log"])
def test_a_load_that_died_is_finished(spark, monkeypatch, lost):
    """Death after the newest versions, the target or before the log, and more has arrived: the next run takes it up."""
    spec = resource_specs.LOCATION
    target, log = session.scratch_path(spark, "loc"), session.scratch_path(spark, "log")
    old = [place(n, "old", 1, 1) for n in range(12)]
    new = [place(n, "new", 5, 2) for n in range(3)]
    resources.load_resource(spark, raw_of(spark, *old), spec, target, log, buckets=4)
    with monkeypatch.context() as broken:
        if lost == "merge":
            broken.setattr(keyed, "replace_keys", lambda *args: 1 / 0)
        elif lost == "replace":
            broken.setattr(keyed.KeyedTable, "_fold", lambda *args: 1 / 0)
        else:
            broken.setattr(resources.runs.PendingWork, "finish", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            resources.load_resource(spark, raw_of(spark, *old, *new), spec, target, log)
    more = [place(20, "more", 9, 3)]
    for _ in range(2):
        resources.load_resource(spark, raw_of(spark, *old, *new, *more), spec, target, log)
    names = sorted(r["prov_dba_name"] for r in keyed.read_keyed(spark, target).collect())
    assert names == ["more"] + ["new"] * 3 + ["old"] * 9
    assert spark.read.parquet(log).count() == 3
    assert resources.runs.PendingWork(spark, f"{log}_work/pending").stored() is None


def test_a_load_reads_only_its_own_slices(spark, tmp_path):
    """Old slices may be gone from the raw table: the newest versions are known; a late old one changes nothing."""
    spec = resource_specs.LOCATION
    target, log, path = session.scratch_path(spark, "loc"), session.scratch_path(spark, "log"), str(tmp_path / "raw")

    def arrive(*rows):
        raw_of(spark, *rows).write.mode("append").partitionBy("load_dt").parquet(path)
        return spark.read.parquet(path)

    raw = arrive(*[place(n, "new", 7, 2) for n in range(6)])
    resources.load_resource(spark, raw, spec, target, log, buckets=4)
    for f in (tmp_path / "raw").rglob("load_dt=*/*.parquet"):
        f.write_bytes(b"not readable any more")
    late = raw_of(spark, *[place(n, "late" if n < 3 else "newer", 3 if n < 3 else 9, 4) for n in range(5)])
    late.write.mode("append").partitionBy("load_dt").parquet(path)
    raw = spark.read.schema(raw.schema).parquet(path)
    resources.load_resource(spark, raw, spec, target, log, arrived=late.select("load_dt"))
    names = sorted(r["prov_dba_name"] for r in keyed.read_keyed(spark, target).collect())
    assert names == ["new"] * 4 + ["newer"] * 2


def test_documents_of_a_processed_day_are_loaded_by_their_batch(spark):
    spec = resource_specs.LOCATION
    target, log = session.scratch_path(spark, "loc"), session.scratch_path(spark, "log")
    first = raw_of(spark, place(1, "one", 1, 1)).withColumn("ingest_batch", F.lit(0))
    second = raw_of(spark, place(2, "two", 1, 1)).withColumn("ingest_batch", F.lit(1))
    for raw in (first, first.unionByName(second), first.unionByName(second)):
        resources.load_resource(spark, raw, spec, target, log, gate="ingest_batch")
    assert sorted(r["prov_dba_name"] for r in keyed.read_keyed(spark, target).collect()) == ["one", "two"]
    assert spark.read.parquet(log).count() == 2


def test_age_bounds_compare_as_numbers(spark):
    def ranged(*bounds):
        return [{"url": "x/age", "valueRange": {"low": {"value": lo}, "high": {"value": hi}}} for lo, hi in bounds]

    doc = {"id": "h", "resourceType": "HealthcareService", "extension": ranged((5, 9), (18, 65), (0.5, 100))}
    row = flat(spark, doc, "HealthcareService")[0]
    assert (row["patient_age_range_low"], row["patient_age_range_high"]) == ("18", "100")


def bundle(*entries, kind, modified=1):
    return raw_row({"id": "b", "resourceType": "Bundle", "entry": [{"resource": r} for r in entries]}, bundle=kind, modified=modified)


def test_network_products_repeat_as_delivered(spark):
    def network(updated, *codes):
        inner = [{"url": "x/productCode", "valueCodeableConcept": {"coding": [{"code": c, "display": c.lower()}]}} for c in codes]
        return {
            "id": "n", "resourceType": "Organization", "meta": {"versionId": "1", "lastUpdated": updated},
            "identifier": [{"value": "P"}, {"value": "P"}], "extension": [{"url": "e", "extension": inner}],
        }

    raw = raw_of(spark, bundle(network("2024-01-01", "OLD"), network("2024-02-01", "A", "B", "A"), kind="Network"))
    rows = dimensions.build_network(raw, F.lit("2024-03-01").cast("date")).collect()
    # two equal identifiers double every product, as the cross product would
    assert sorted(r["product_cd"] for r in rows) == ["A"] * 4 + ["B"] * 2


def test_unreadable_dates_become_null_and_outer_tag_wins(spark):
    act = {
        "id": "e", "resourceType": "Basic", "meta": {"versionId": "1", "lastUpdated": "2024-01-01"},
        "extension": [
            {"url": "planCode", "valueCode": "outer", "extension": [{"url": "planCode", "valueCode": "zz-inner"}]},
            {"url": "peiIdEffectivePeriod", "valuePeriod": {"start": "2024-02-03", "end": "tomorrow"}},
        ],
    }
    row = dimensions.build_dimension(raw_of(spark, bundle(act, kind="ProviderEntityIdentifier")), "dim_provider_entity").first()
    assert row["plan_cd"] == "outer"
    assert row["pei_eff_period_start"] == dt.date(2024, 2, 3) and row["pei_eff_period_end"] is None


def test_versions_order_as_numbers_unless_asked_for_text(spark):
    layout = ", ".join(f"{c} string" for c in history.ROLE_COLUMNS)

    def role(version):
        fixed = {"file_record_id": "r", "file_export_type": "E", "location_ref_record_id": "l", "version_id": version}
        return tuple(fixed.get(c) for c in history.ROLE_COLUMNS)

    table = spark.createDataFrame([role("9"), role("10")], layout)
    assert history.current_roles(table, "E").first()["version_id"] == "10"
    assert history.current_roles(table, "E", as_text=True).first()["version_id"] == "9"


def test_roles_at_temporary_or_unknown_locations_drop(spark):
    layout = ", ".join(f"{c} string" for c in history.ROLE_COLUMNS)
    rows = [
        tuple({"file_record_id": str(i), "file_export_type": "E", "location_ref_record_id": loc}.get(c) for c in history.ROLE_COLUMNS)
        for i, loc in enumerate(["l1", "xTLOC1", "TFLOC", None])
    ]
    assert [r[0] for r in history.current_roles(spark.createDataFrame(rows, layout), "E").collect()] == ["0"]


def test_taxonomy_slots_merge_both_lists(spark):
    table = spark.createDataFrame(
        [
            ("E", "both", "1:true||2:false", "1:one\n2:two\n"),
            ("E", "left", "1:true", ""),
            ("E", "right", "", "1:one\n"),
            ("E", "six", "1:true||2:true||3:true||4:true||5:true||6:true", ""),
        ],
        "file_export_type string, file_record_id string, board_certification_ind string, taxonomy_desc string",
    )
    rows = {r["file_record_id"]: r for r in history.provider_taxonomy(table).collect()}
    assert rows["both"]["taxonomy_cd_1"] == "1" and rows["both"]["taxonomy_desc_2"] == "two"
    assert rows["left"]["taxonomy_1_board_certification"] == "true" and rows["left"]["taxonomy_desc_1"] == ""
    assert rows["right"]["file_export_type"] == "E" and rows["right"]["taxonomy_desc_1"] == "one"
    assert rows["six"]["taxonomy_cd_5"] == "5" and rows["left"]["taxonomy_cd_2"] is None
