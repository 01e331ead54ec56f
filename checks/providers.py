"""Provider resources and reference dimensions against SQL on the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import provider_documents as docs
from checks.registry import check, table
from millrace import session
from millrace.plans import dimensions, resource_specs, resources
from millrace.sources import keyed, newest

LOAD_DAY = "2024-09-09"


def filled(layout: list[str], given: dict[str, str]) -> str:
    """Select list over a whole layout; columns not given are ''."""
    unknown = set(given) - set(layout)
    if unknown:
        raise ValueError(f"not in the layout: {sorted(unknown)}")
    return ", ".join(f"{given.get(c, chr(39) * 2)} as \"{c}\"" for c in layout)


def head(record: str, kind: str, version: str = "1", export: str = f"'{docs.EXPORT}'") -> dict[str, str]:
    return {
        "file_export_type": export,
        "file_record_id": record,
        "version_id": f"cast({version} as varchar)",
        "last_updtd_ts": f"'2024-0' || {version} || '-01'",
        "profile_type": f"'{kind}'",
        "load_dt": f"cast('2024-0' || {version} || '-02' as date)",
    }


NULL = "cast(null as varchar)"
PRACTITIONER_KEY = "lpad(cast(c_nationkey as varchar), 3, '0') || 'c' || c_custkey || '-prac'"
TAXONOMY = "'TX' || substr(c_mktsegment, 1, 3)"


def known(value: str, otherwise: str = "''") -> str:
    return f"case when c_acctbal >= 0 then {value} else {otherwise} end"


PRACTITIONER_COLUMNS = {
    **head(PRACTITIONER_KEY, "prac", "case when c_acctbal > 5000 then 2 else 1 end"),
    "plan_prov_id_type_list": "'NPI PCRN PRN' || case when c_nationkey < 10 then ' TAX' else '' end",
    "plan_prov_id": "'PR' || c_custkey",
    "national_prov_id": "'N' || c_custkey",
    "cross_reference_plan_prov_id": "'N' || c_custkey",
    "cross_reference_plan_prov_id_eff_dt": "'2020-01-01'",
    "cross_reference_plan_prov_id_end_dt": "'2021-01-01'",
    "prov_tax_id": "case when c_nationkey < 10 then 'T' || c_custkey else '' end",
    "prov_tax_id_type": "case when c_nationkey < 10 then 'TAX' else '' end",
    "taxonomy_cd": known(TAXONOMY),
    "taxonomy_desc": known(f"{TAXONOMY} || ':' || c_mktsegment || ' care' || chr(10)"),
    "prov_medical_school": known("'org' || c_nationkey || '-org'"),
    "prov_medical_school_year": known("'1999-06-30'"),
    "board_certification_ind": known(
        f"':||' || {TAXONOMY} || ':' || case when c_acctbal > 1000 then 'true' else 'false' end", "':'"
    ),
    "board_certification_issuing_organization": known(f"':||' || {TAXONOMY} || ':board'", "':'"),
    "prov_credential": known(TAXONOMY, NULL),
    "prov_license_state": known("'S' || c_nationkey", NULL),
    "prov_last_name": "c_name",
    "prov_first_name": "c_mktsegment",
    "prov_middle_initial": "'M'",
    "prov_name_suffix": NULL,
    "jobtitle": "'Dr'",
    "birth_dt": "(1950 + c_nationkey) || '-01-01'",
    "prov_gender": "case when c_nationkey > 12 then 'female' else 'male' end",
    "active_ind": "'true'",
    "communication": "chr(10) || 'en:English'",
    "city": "'City' || c_nationkey",
    "country": "'US'",
    "addr_line1": "'1 Main'",
    "addr_line2": "'Apt ' || c_nationkey",
    "state": "'S' || c_nationkey",
    "type": "'both'",
    "use": "'work'",
}


@check(
    "fhir_practitioner",
    f"select {filled(resource_specs.PRACTITIONER.layout, PRACTITIONER_COLUMNS)} from customer",
)
def fhir_practitioner(spark: SparkSession, folder: str) -> DataFrame:
    return resources.flatten_resource(docs.practitioners(spark, folder), resource_specs.PRACTITIONER)


ROLE_COLUMNS = {
    **head(
        "'role' || o_orderkey || '-role'",
        "role",
        "case when o_orderstatus = 'F' and d = 5 then 2 else 1 end",
        f"case when o_orderstatus = 'F' and d = 5 then '{docs.OTHER_EXPORT}' else '{docs.EXPORT}' end",
    ),
    "practitioner_ref_record_id": PRACTITIONER_KEY,
    "organization_ref_record_id": "'org' || d || '-org'",
    "licensee_ref_record_id": "'lic' || c_nationkey",
    "network_ref_record_id": "net",
    "location_ref_record_id": "loc",
    "healthcare_service_ref_record_id": "'svc' || d || '-svc'",
    "prov_entity_id": "'E' || o_orderkey",
    "prov_type_cd": "'T1'",
    "prov_type_display": "'Type one'",
    "prov_type_system": "'http://x/BCBSProviderTypeCS'",
    "prov_entity_type_cd": "'E1'",
    "prov_entity_type_display": "'Entity one'",
    "prov_entity_type_system": "'http://x/BCBSProviderEntityTypeCS'",
    "patient_age_range_high": "'65'",
    "patient_age_range_low": "'18'",
    "prov_patient_gender_limit": "'female'",
    "prov_eff_dt": "strftime(o_orderdate, '%Y-%m-%d')",
    "prov_term_dt": "'2030-12-31'",
    "accepting_new_patients_cd": "'newpt'",
    "value_based_program_id": "'VA VB' || d",
    "pcp_ind_cd": "'Y'",
    "pcp_eff_dt": "'2022-01-01'",
    "pcp_end_dt": "'2023-01-01'",
    "pcp_selectability_cd": "'S'",
    "prov_reimbursement_cd": "'R'",
    "prov_termination_cd": "'TR1'",
    "specialty_cd": "o_orderpriority",
    "specialty_display": "'Sp ' || o_orderstatus",
    "specialty_system": "'http://x/sp'",
    "days_of_week_and_office_hours": (
        "case when d >= 4 then 'd1:17-08,d2:17-08,d3:17-08,d4:17-08,d5:17-08' end"
    ),
    "prov_accepts_member_select_attrib_ind": "case when o_orderstatus <> 'O' then 'true' else 'false' end",
    "display_ind_prov": "'true'",
    "display_suppression_reason_prov": "'D'",
    "prov_contract_status": "case when o_orderstatus = 'O' then 'true' else 'false' end",
    "prov_affil_type": "'hosp'",
    "prov_affil_ref": "'h7'",
    "prov_affil_network": "'n7'",
    "tier_designation_cd": """'{"code":"G","display":"Gold","system":"http://x/tier"}'""",
}
ROLE_SOURCE = """
(select *, unnest(case when o_orderstatus = 'F' then [''] when o_orderstatus = 'O' then ['net' || d]
   else ['net' || d, 'net' || (d + 1)] end) as net from
  (select *, unnest(case when d = 1 then [null] else ['loc' || i || '-loc' for i in range(1, least(d, 3))] end) as loc from
    (select *, cast(substr(o_orderpriority, 1, 1) as int) as d from orders join customer on o_custkey = c_custkey)))
"""


@check(
    "fhir_practitioner_role",
    f"select {filled(resource_specs.PRACTITIONER_ROLE.layout, ROLE_COLUMNS)} from {ROLE_SOURCE}",
)
def fhir_practitioner_role(spark: SparkSession, folder: str) -> DataFrame:
    return resources.flatten_resource(docs.roles(spark, folder), resource_specs.PRACTITIONER_ROLE)


def telecom_sql() -> dict[str, str]:
    out = {}
    for system, value, use in (
        ("phone", "'1-' || s_suppkey", "'work'"),
        ("fax", "'2-' || s_suppkey", "'work'"),
        ("url", "'http://' || s_suppkey", "' '"),
    ):
        has = "true" if system == "phone" else "s_nationkey < 12"
        out[f"prov_communication_info_type_{system}"] = f"case when {has} then '{system}' else ' ' end"
        out[f"prov_communication_info_{system}"] = f"case when {has} then {value} else ' ' end"
        out[f"prov_communication_info_purpose_{system}"] = f"case when {has} then {use} else ' ' end"
    return out


def day_line(i: int) -> str:
    return f"case when s_nationkey // 5 + 1 >= {i} then 'd{i} 08-17' else ' ' end"


LOCATION_COLUMNS = {
    **head("'loc' || s_suppkey || '-loc'", "loc"),
    "provider_location_master_identifier": "'PLM' || s_suppkey",
    "prov_dba_name": "s_name",
    "prov_addr_city": "'City' || s_nationkey",
    "prov_addr_district": "'D'",
    "prov_addr_state": "'S' || s_nationkey",
    "prov_addr_postalcd": "lpad(cast(s_nationkey as varchar), 5, '7') || '-1234'",
    "prov_addr_country": "'US'",
    "prov_addr_use": "'work'",
    "prov_addr_line1": "'2 Main'",
    "prov_addr_line2": NULL,
    **telecom_sql(),
    "days_of_week_and_office_hours": " || chr(10) || ".join(day_line(i) for i in range(1, 8)),
    "position_latitude": "'35.5'",
    "position_longitude": "'-92.25'",
    "prov_staff_language": "chr(10) || 'en:EnglishUS' || chr(10) || 'fr:'",
    "prov_termination_cd": "'PT:term'",
    "service_area_cd": "case when s_nationkey > 5 then 'SA:' end",
    "geocoding_return_cd": NULL,
    "metropolitan_statistical_area": "'M1:metro'",
}


@check("fhir_location", f"select {filled(resource_specs.LOCATION.layout, LOCATION_COLUMNS)} from supplier")
def fhir_location(spark: SparkSession, folder: str) -> DataFrame:
    return resources.flatten_resource(docs.locations(spark, folder), resource_specs.LOCATION)


def at(work: str, home: str) -> str:
    return f"case place when 'work' then {work} when 'home' then {home} end"


ORGANIZATION_COLUMNS = {
    **head("'org' || s_suppkey || '-org'", "org"),
    "prov_organization_name": "'Org ' || s_name",
    "plan_prov_id": "'PR' || s_suppkey",
    "prov_master_id": NULL,
    "national_prov_id_list": "'N1 N2'",
    "cms_certification_number": "'C' || s_suppkey",
    "prov_tax_id": "'TID'",
    "prov_tax_id_type": "'ITIN'",
    "other_plan_prov_id": "'free'",
    "prov_addr_use": "place",
    "prov_addr_type": at("'both'", "'postal'"),
    "prov_addr_district": at("'D'", "null"),
    "prov_addr_state": at("'ST'", "'SU'"),
    "prov_addr_postal_cd": at("'72201'", "'72202'"),
    "prov_addr_country": at("'US'", "null"),
    "prov_addr_text": at("s_name", "null"),
    "prov_addr_line1": at("'3 Main'", "'4 Main'"),
    "prov_addr_line2": at("'Floor 2'", "null"),
    "prov_addr_start": at("'2010-01-01'", "null"),
    "prov_addr_end": NULL,
    **telecom_sql(),
    "licensee_entity_cd": NULL,
    "plan_cd": "'XX'",
    "licensee_hierarchy_cd": NULL,
    "network_ref_record_id": "net",
    "licensee_ref_record_id": "'lic1'",
}
ORGANIZATION_SOURCE = """
(select *, unnest(case when s_nationkey > 12 then ['net1', 'net2'] else [''] end) as net from
  (select *, unnest(case when s_nationkey > 3 then ['work', 'home'] else [null] end) as place from supplier))
"""


@check(
    "fhir_organization",
    f"select {filled(resource_specs.ORGANIZATION.layout, ORGANIZATION_COLUMNS)} from {ORGANIZATION_SOURCE}",
)
def fhir_organization(spark: SparkSession, folder: str) -> DataFrame:
    return resources.flatten_resource(docs.organizations(spark, folder), resource_specs.ORGANIZATION)


AFFILIATION_COLUMNS = {
    **head("'aff' || p_partkey || '-aff'", "aff"),
    "network_ref_record_id": "'net' || (p_size // 5)",
    "licensee_ref_record_id": "'lic' || (p_size // 3)",
    "healthcare_service_ref_record_id": "'svc' || i || '-svc'",
    "location_ref_record_id": "case when p_size > 10 then 'loc' || p_size || '-loc' end",
    "participating_organization_ref_record_id": "'org' || p_size || '-org'",
    "prov_type_cd": "'T2'",
    "prov_type_display": "'Type two'",
    "prov_type_system": "'http://x/BCBSProviderTypeCS'",
    "prov_eff_dt": "'2021-01-01'",
    "prov_term_dt": NULL,
    "pcp_ind_cd": "'Y:yes'",
    "pcp_selectability_cd": "'S'",
    "days_of_week_and_office_hours": NULL,
    "value_based_program_id_list": "'VB'",
    "prov_entity_id": "'PEI' || p_partkey",
    "display_ind_prov": "'false'",
    "prov_affliation_type": "'hosp:h' || p_size",
    "affliation_desc": "p_name",
}
AFFILIATION_SOURCE = "(select *, unnest(range(1, least(p_size // 7, 5) + 1)) as i from part)"


@check(
    "fhir_org_affiliation",
    f"select {filled(resource_specs.ORG_AFFILIATION.layout, AFFILIATION_COLUMNS)} from {AFFILIATION_SOURCE}",
)
def fhir_org_affiliation(spark: SparkSession, folder: str) -> DataFrame:
    # parts below size seven have no services and drop
    return resources.flatten_resource(docs.affiliations(spark, folder), resource_specs.ORG_AFFILIATION)


SERVICE_COLUMNS = {
    **head("'svc' || p_partkey || '-svc'", "svc"),
    "healthcare_service_type_cd": "'t' || i",
    "healthcare_service_type": "p_type || ' ' || i",
    "prov_type_cd": "'T3'",
    "prov_type_display": "'Type three'",
    "patient_age_range_high": "'10'",
    "patient_age_range_low": "'1'",
    "prov_patient_gender_limit": "'male'",
    "accepting_new_patients_cd": "'existing'",
    "specialty_cd": "p_brand",
    "specialty_display": "p_name",
}


@check(
    "fhir_healthcare_service",
    f"select {filled(resource_specs.HEALTHCARE_SERVICE.layout, SERVICE_COLUMNS)} "
    "from (select *, unnest(range(1, p_size // 20 + 2)) as i from part)",
)
def fhir_healthcare_service(spark: SparkSession, folder: str) -> DataFrame:
    return resources.flatten_resource(docs.services(spark, folder), resource_specs.HEALTHCARE_SERVICE)


PLAN_COLUMNS = {
    **head("'plan' || p_partkey || '-plan'", "plan"),
    "administered_by_ref_record_id": "p_brand",
    "network_ref_record_id": "net",
    "descriptive_product_name": "p_name",
    "program_affil_type_cd": "p_type",
    "program_affil_type": "lower(p_type)",
    "bcbs_product_type_cd": "p_brand",
    "memprefix": "'M' || p_size",
}


@check(
    "fhir_insurance_plan",
    f"select {filled(resource_specs.INSURANCE_PLAN.layout, PLAN_COLUMNS)} from (select *, unnest(case when p_size < 20 "
    "then ['net1', 'net0'] when p_size < 40 then ['net1'] else ['net1', 'net2'] end) as net from part)",
)
def fhir_insurance_plan(spark: SparkSession, folder: str) -> DataFrame:
    # `sequence(1, 0)` counts down, so small parts reference networks 1 and 0
    return resources.flatten_resource(docs.plans(spark, folder), resource_specs.INSURANCE_PLAN)


def per_measure(first: str, second: str = "''") -> str:
    return f"case m when 1 then {first} else {second} end"


MEASURE_COLUMNS = {
    **head("'basic' || p_partkey || '-embold'", "embold"),
    "licensee_ref_record_id": per_measure("'lic9'"),
    "quality_recognition_type_cd": "p_type",
    "quality_recognition_type_display": "p_name",
    "recognition_webaddr": per_measure("''", "'http://q'"),
    "recognition_period": per_measure("'2020:'"),
    "master_id": "'MI' || p_partkey",
    "master_id_type": "'PLM'",
    "hospital_type": per_measure("p_brand"),
    "decile": per_measure("cast(p_size as varchar)"),
    "zscore": per_measure("rtrim(rtrim(cast(cast(p_size / 4 as decimal(10,2)) as varchar), '0'), '.')"),
    "messaging": per_measure("''", "p_name"),
}


@check(
    "fhir_basic_measures",
    f"select {filled(resource_specs.BASIC_MEASURES.layout, MEASURE_COLUMNS)} "
    "from (select *, unnest(case when p_size > 25 then [1, 2] else [1] end) as m from part)",
)
def fhir_basic_measures(spark: SparkSession, folder: str) -> DataFrame:
    return resources.flatten_resource(docs.measures(spark, folder), resource_specs.BASIC_MEASURES)


LOADED_ONCE = f"""
select file_record_id, version_id, load_dt from (
  select {filled(resource_specs.PRACTITIONER.layout, PRACTITIONER_COLUMNS)} from customer)
"""


@check("fhir_incremental_load", LOADED_ONCE)
def fhir_incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """Slices arriving one after the other, each loaded once, newer versions replacing older ones."""
    target, log = (session.scratch_path(spark, x) for x in ("practitioner", "practitioner-log"))
    raw = docs.practitioners(spark, folder)
    first = raw.where("load_dt = date'2024-01-02'")
    for arrived in (first, raw, raw):
        resources.load_resource(spark, arrived, resource_specs.PRACTITIONER, target, log, buckets=8)
    return keyed.read_keyed(spark, target).select("file_record_id", "version_id", "load_dt")


@check(
    "late_version",
    """
with r as (select cast(o_custkey as varchar) as record, o_orderkey, o_orderdate, o_orderstatus from orders)
select record, o_orderkey from r
where o_orderstatus = 'P' and o_orderdate = (select max(o_orderdate) from r x where x.record = r.record)
""",
)
def late_version(spark: SparkSession, folder: str) -> DataFrame:
    """Slice 'P' arrives last; only its rows that are the newest of their record anywhere count."""
    raw = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("record"), "o_orderkey", "o_orderdate", "o_orderstatus"
    )
    known = newest.NewestVersions(spark, session.scratch_path(spark, "newest"), ["record"], "o_orderdate", buckets=8)
    slices = raw.select("o_orderstatus").distinct()
    late = F.col("o_orderstatus") == "P"
    known.merge(newest.within_slices(raw, slices.where(~late), "o_orderstatus"), "before")
    return known.merge(newest.within_slices(raw, slices.where(late), "o_orderstatus"), "late").select("record", "o_orderkey")


# --- dimensions --------------------------------------------------------------------


def dimension(spark: SparkSession, raw: DataFrame, name: str) -> DataFrame:
    return dimensions.build_dimension(raw, name, F.lit(LOAD_DAY).cast("date"))


def dim_head(version: str, kind: str) -> dict[str, str]:
    return {
        "last_updated": f"'2024-0' || {version} || '-01'",
        "version_id": f"cast({version} as varchar)",
        "resource_type": f"'{kind}'",
        "load_dt": f"date '{LOAD_DAY}'",
    }


def dim_sql(name: str, given: dict[str, str], source: str) -> str:
    return f"select {filled(list(dimensions.DIMENSIONS[name].layout), given)} from {source}"


NEWEST_PLAN = "case when p_size > 40 then 3 else 1 end"


@check(
    "dim_insurance_plan",
    dim_sql(
        "dim_insurance_plan",
        {
            **dim_head(NEWEST_PLAN, "InsurancePlan"),
            "insurance_plan_id": "'ip' || p_partkey",
            "insurance_plan_name": "p_name",
            "memprefix": "case when p_size > 30 then 'M' || p_size else '' end",
            "network_id": "net",
            "licensee_id": "'own' || p_size",
            "insurance_plan_cd": "'pl' || p_partkey",
            "insurance_plan_cd_desc": "p_brand",
            "product_type_cd": "p_type",
            "product_type_cd_desc": f"'v' || {NEWEST_PLAN}",
            "program_affl_type_cd": "'PA'",
            "program_affl_type_cd_desc": "'prog'",
        },
        "(select *, unnest(['Network/net' || p_size, 'Network/nex' || p_size]) as net from part)",
    ),
)
def dim_insurance_plan(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.plan_bundles(spark, folder), "dim_insurance_plan")


@check(
    "dim_licensee",
    dim_sql(
        "dim_licensee",
        {
            **dim_head("2", "Organization"),
            "insurance_licensee_id": "'lic' || n_nationkey",
            "plan_cd": "lpad(cast(n_nationkey as varchar), 3, '0')",
            "plan_cd_desc": "'Plan of ' || n_name",
            "licensee_hierarchy_cd": "'H' || n_nationkey",
            "licensee_entity_cd": "'L2-' || n_nationkey",
            "licensee_entity_cd_desc": "'entity'",
        },
        docs.MANY_AREAS,
    ),
)
def dim_licensee(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.licensee_bundles(spark, folder, docs.many_areas), "dim_licensee")


@check(
    "dim_network",
    dim_sql(
        "dim_network",
        {
            **dim_head("2", "Organization"),
            "organization_id": "'net' || n_net",
            "insurance_licensee_id": "'lic' || n_net",
            "product_id": "'PN' || n_nationkey",
            "product_id_desc": "n_name",
            "period_start": "'2000-01-01'",
            "period_end": "case when n_regionkey > 1 then '2030-12-31' else '2010-12-31' end",
            "product_cd": "p.code",
            "product_cd_desc": "p.label",
            "prov_product_type_cd": "'PT'",
            "prov_product_type_cd_desc": "'prod type'",
            "prov_program_type_cd": "'G' || n_regionkey",
            "prov_program_type_cd_desc": "'pgm'",
        },
        f"{docs.MANY_AREAS}, (values ('PC1', 'one v2'), ('PC2', 'two'), ('PC2', 'two')) as p(code, label)",
    ),
)
def dim_network(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.network_bundles(spark, folder, docs.many_areas), "dim_network")


@check(
    "dim_healthcare_system",
    dim_sql(
        "dim_healthcare_system",
        {
            **dim_head("3", "Organization"),
            "healthcare_system_id": "'hs' || s_suppkey",
            "healthcare_system_identfier": "'HS' || s_suppkey",
            "healthcare_system_identfier_type": "'HSI'",
            "healthcare_system_name": "s_name || ' v3'",
            "address_city": "'City' || s_nationkey",
            "address_state": "'AR'",
        },
        "supplier",
    ),
)
def dim_healthcare_system(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.system_bundles(spark, folder), "dim_healthcare_system")


@check(
    "dim_state_county_zip",
    dim_sql(
        "dim_state_county_zip",
        {
            **dim_head("2", "Basic"),
            "id": "'zip' || n_nationkey",
            "zip_cd": "lpad(cast(n_nationkey as varchar), 5, '7')",
            "longitude": "'-92.1'",
            "latitude": "'34.7'",
            "city": "'City' || n_nationkey",
            "county_cd": "'0' || n_nationkey",
            "county_name": "'County ' || n_name || ' v2'",
            "state_fips_cd": "'05'",
            "cbsa_cd": "'C9'",
            "state_cd": "'S' || n_nationkey",
            "state_name": "n_name",
        },
        docs.MANY_AREAS,
    ),
)
def dim_state_county_zip(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.zip_bundles(spark, folder, docs.many_areas), "dim_state_county_zip")


NEWEST_ENTITY = "case when c_acctbal > 0 then 2 else 1 end"


@check(
    "dim_provider_entity",
    dim_sql(
        "dim_provider_entity",
        {
            **dim_head(NEWEST_ENTITY, "Basic"),
            "id": "'pe' || c_custkey",
            "plan_cd": "c_mktsegment",
            "vbp_id": "'vb' || c_custkey",
            "pei_cd": "'pe'",
            "pei_cd_name": "c_name",
            "cycle_id": "'cy'",
            "pei_eff_period_start": f"cast('2020-01-0' || {NEWEST_ENTITY} as date)",
            "pei_eff_period_end": "cast(null as date)",
            "admin_act": "case when c_nationkey > 12 then 'add' else 'update' end",
        },
        "customer",
    ),
)
def dim_provider_entity(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.entity_bundles(spark, folder), "dim_provider_entity")


@check(
    "dim_value_program",
    dim_sql(
        "dim_value_program",
        {
            **dim_head("1", "Basic"),
            "id": "'vp' || p_partkey",
            "admin_act": "'act'",
            "plan_cd": "p_brand",
            "vbp_id": "'vb' || p_partkey",
            "vbp_program_type_cd": "p_type",
            "vbp_scope_cd": "'sc'",
            "vbp_program_name": "p_name",
            "vbp_eff_start": "date '2019-01-01'",
            "vbp_eff_end": "cast(null as date)",
            "de_designation_dt": "case when p_size > 25 then date '2023-05-06' end",
            "total_care_eff_start": "date '2021-02-03'",
            "total_care_eff_end": "date '2022-02-03'",
        },
        "part",
    ),
)
def dim_value_program(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, docs.program_bundles(spark, folder), "dim_value_program")
