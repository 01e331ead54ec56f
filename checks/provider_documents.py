"""Provider documents that Spark builds from the given tables, one per row.

Practitioners come from customers, roles from orders, locations and
organizations from suppliers, affiliations, services, plans and measures from
parts, reference bundles from nations, customers and parts. Values are invented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from millrace.sources import ndjson

EXPORT = "DemographicExport"
OTHER_EXPORT = "AnalyticsExport"
PII_EXPORT = "AnalyticsExportPII"

TEXT = "cast(null as string)"


def obj(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {x}" for n, x in fields.items()) + ")"


def arr(*items: str) -> str:
    """An array without its NULL items, which only `opt` gives."""
    listed = f"array({', '.join(items)})"
    return f"filter({listed}, z -> z is not null)" if any(i.startswith("if(") for i in items) else listed


def opt(condition: str, item: str) -> str:
    return f"if({condition}, {item}, null)"


def coding(code: str, system: str = TEXT, display: str = TEXT) -> str:
    return obj(system=system, code=code, display=display)


def concept(*codings: str) -> str:
    return obj(coding=arr(*codings))


def ident(value: str, *codes: str, start: str = TEXT, end: str = TEXT, label: str = TEXT) -> str:
    return obj(
        value=value,
        type=concept(*[coding(f"'{c}'") for c in codes]) if codes else "cast(null as struct<coding:array<struct<system:string,code:string,display:string>>>)",
        period=obj(start=start, end=end),
        assigner=obj(display=label),
    )


def ref(value: str) -> str:
    return obj(reference=value)


NO_CONCEPT = "cast(null as struct<coding:array<struct<system:string,code:string,display:string>>>)"


def _carriers(given: dict[str, str]) -> dict[str, str]:
    """All value carriers of an extension, the ones not given being NULL."""
    return {
        "valueString": given.get("string", TEXT),
        "valueCode": given.get("code", TEXT),
        "valueDate": given.get("date", TEXT),
        "value": given.get("value", TEXT),
        "valueUrl": given.get("link", TEXT),
        "valueBoolean": given.get("boolean", "cast(null as boolean)"),
        "valueInteger": given.get("integer", "cast(null as bigint)"),
        "valueDecimal": given.get("decimal", "cast(null as decimal(10,2))"),
        "valueReference": ref(given.get("ref", TEXT)),
        "valuePeriod": obj(start=given.get("start", TEXT), end=given.get("end", TEXT)),
        "valueIdentifier": obj(value=given.get("identifier", TEXT)),
        "valueRange": obj(low=obj(value=given.get("low", TEXT)), high=obj(value=given.get("high", TEXT))),
        "valueCodeableConcept": given.get("concept", NO_CONCEPT),
    }


def inner(url: str, **given: str) -> str:
    return obj(url=f"'{url}'", **_carriers(given))


NO_INNER = f"filter(array({inner('')}), z -> false)"


def ext(url: str, *inners: str, **given: str) -> str:
    return obj(url=f"'{url}'", **_carriers(given), extension=arr(*inners) if inners else NO_INNER)


def raw_rows(
    rows: DataFrame,
    kind: str,
    record: str,
    doc: dict[str, str],
    *,
    export: str = f"'{EXPORT}'",
    bundle: str = "'main'",
    version: str = "1",
) -> DataFrame:
    """Raw document rows: one per input row, month and slice given by the version."""
    body = {
        "id": record,
        "resourceType": f"'{kind}'",
        "meta": obj(versionId=f"cast({version} as string)", lastUpdated=f"concat('2024-0', {version}, '-01')"),
        **doc,
    }
    # a small table is one file; documents are costly to make and to parse, so all cores take part
    stamped = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism).selectExpr(
        f"concat('FHIR/in/', {export}, '/d/', {bundle}, '/f.ndjson') as file_name",
        "cast(1 as bigint) as file_row_number",
        "'key' as file_content_key",
        f"to_timestamp(concat('2024-0', {version}, '-01')) as file_last_modified",
        "to_timestamp('2024-09-01') as start_scan_time",
        f"'{kind}' as file_resource_type",
        f"{record} as file_record_id",
        f"to_json({obj(**body)}) as file_content_raw",
        f"to_date(concat('2024-0', {version}, '-02')) as load_dt",
    )
    return stamped.select(*ndjson.RAW_COLUMNS)


def versions(rows: DataFrame, condition: str) -> DataFrame:
    """Each row as version 1, and as version 2 where the condition holds."""
    return rows.withColumn("v", F.explode(F.expr(f"if({condition}, array(1, 2), array(1))")))


# --- Practitioner: customers ------------------------------------------------------

PRACTITIONER_ID = "concat(lpad(c_nationkey, 3, '0'), 'c', c_custkey, '-prac')"


def practitioners(spark: SparkSession, folder: str, export: str = EXPORT) -> DataFrame:
    state = "concat('S', c_nationkey)"
    first = obj(
        identifier=arr(obj(value="concat(' li ', c_custkey)")),
        issuer=obj(reference="'Organization/board'", display="'The board'"),
        period=obj(end=TEXT),
        code=obj(
            coding=arr(coding("concat('TX', substr(c_mktsegment, 1, 3))", "'http://x/provider-taxonomy'", "concat(c_mktsegment, '  care')")),
            extension=arr(
                obj(
                    url="'http://x/boardcertificationindicator'",
                    valueBoolean="c_acctbal > 1000",
                    extension=arr(
                        obj(url="'whereValid'", valueCode=TEXT, valueCodeableConcept=concept(coding(state))),
                        obj(url="'status'", valueCode="'active'", valueCodeableConcept=NO_CONCEPT),
                    ),
                )
            ),
        ),
        extension=arr(obj(valueCode="'boardcert'")),
    )
    second = obj(
        identifier="filter(array(named_struct('value', 'x')), z -> false)",
        issuer=obj(reference="concat('Organization/org', c_nationkey, '-org')", display=TEXT),
        period=obj(end="'1999-06-30'"),
        code=obj(
            coding=arr(coding("'MEDSCHL'", "'http://x/degree'", "'Medical school'")),
            extension="filter(array(named_struct('url', '', 'valueBoolean', true, 'extension', array(named_struct('url', '', "
            f"'valueCode', {TEXT}, 'valueCodeableConcept', {NO_CONCEPT})))), z -> false)",
        ),
        extension=arr(obj(valueCode="'degree'")),
    )
    doc = {
        "birthDate": "concat(cast(1950 + c_nationkey as string), '-01-01')",
        "gender": "if(c_nationkey > 12, 'female', 'male')",
        "active": "true",
        "identifier": arr(
            ident("concat('PR', c_custkey)", "PRN"),
            ident("concat('N', c_custkey)", "NPI", "PCRN", start="'2020-01-01'", end="'2021-01-01'"),
            opt("c_nationkey < 10", ident("concat('T', c_custkey)", "TAX")),
        ),
        "qualification": opt("c_acctbal >= 0", arr(first, second)),
        "name": arr(
            obj(family="c_name", given="array(c_mktsegment, 'M')", extension=obj(jobtitle="'Dr'"))
        ),
        "communication": arr(concept(coding("'en'", display="'English'"), coding("'es'"))),
        "address": arr(
            obj(
                city="concat('City', c_nationkey)",
                country="'US'",
                line="array('1 Main', concat('Apt ', c_nationkey))",
                state=state,
                type="'both'",
                use="'work'",
            )
        ),
        "telecom": arr(
            obj(system="'phone'", value="'555'", use="'work'"),
            opt("c_nationkey < 5", obj(system="'email'", value="concat('c', c_custkey, '@x.org')", use="'work'")),
        ),
    }
    rows = versions(table(spark, folder, "customer"), "c_acctbal > 5000")
    return raw_rows(rows, "Practitioner", PRACTITIONER_ID, doc, export=f"'{export}'", version="v")


# --- PractitionerRole: orders ---------------------------------------------------

DIGIT = "cast(substr(o_orderpriority, 1, 1) as int)"
ROLE_ID = "concat('role', o_orderkey, '-role')"


def roles(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of status 'F' also have a newer version in another export type."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    rows = versions(rows, "o_orderstatus = 'F' and o_orderpriority = '5-LOW'")
    digit = DIGIT
    doc = {
        "practitioner": ref(f"concat('Practitioner/', {PRACTITIONER_ID})"),
        "organization": ref(f"concat('Organization/org', {digit}, '-org')"),
        "period": obj(start="date_format(o_orderdate, 'yyyy-MM-dd')", end="'2030-12-31'"),
        "location": opt(
            f"{digit} > 1",
            f"transform(sequence(1, least({digit} - 1, 2)), i -> {ref(concat_id('Location/loc', 'i', '-loc'))})",
        ),
        "healthcareService": f"array({ref(concat_id('HealthcareService/svc', digit, '-svc'))})",
        "identifier": arr(ident("concat('E', o_orderkey)", "PEI"), ident("concat('A', o_orderkey)", "X")),
        "code": arr(
            concept(
                coding("'T1'", "'http://x/BCBSProviderTypeCS'", "'Type one'"),
                coding("'E1'", "'http://x/BCBSProviderEntityTypeCS'", "'Entity one'"),
            )
        ),
        "specialty": arr(concept(coding("o_orderpriority", "'http://x/sp'", "concat('Sp ', o_orderstatus)"))),
        "extension": arr(
            ext("http://x/licenseereference", ref="concat('Licensee/lic', c_nationkey)"),
            opt("o_orderstatus <> 'F'", ext("http://x/networkreference", ref=f"concat('Network/net', {digit})")),
            opt("o_orderstatus = 'P'", ext("http://x/networkreference", ref=f"concat('Network/net', {digit} + 1)")),
            ext("http://x/provcontract", boolean="o_orderstatus = 'O'"),
            ext("http://x/provtierdesig", concept=concept(coding("'G'", "'http://x/tier'", "'Gold'"))),
            ext("http://x/age", low="'5'", high="'9'"),
            ext("http://x/age", low="'18'", high="'65'"),
            ext(
                "http://x/term",
                concept=concept(
                    coding("'TR1'", "'http://x/BCBSProviderTerminationReasonCS'", "'left'")
                ),
            ),
            ext(
                "http://x/details",
                inner("characteristics", string="'female'"),
                inner("acceptingPatients", concept=concept(coding("'newpt'"))),
                inner("pcpIndicatorCode", concept=concept(coding("'Y'", display="'yes'"))),
                inner("pcpSelectabilityCode", concept=concept(coding("'S'"))),
                inner("providerReimbursementCode", concept=concept(coding("'R'"))),
                inner("pcpEffectivePeriod", start="'2022-01-01'", end="'2023-01-01'"),
                inner("valueBasedProgramIdentifier", identifier=f"concat('VB', {digit})"),
                inner("valueBasedProgramIdentifier", identifier="'VA'"),
                inner("providerAcceptsMemberSelectAttributionIndicator", boolean="o_orderstatus <> 'O'"),
                inner("displayIndicatorProvider", boolean="true"),
                inner("displaySuppressionReasonProvider", concept=concept(coding("'D'"))),
                inner("provAffType", concept=concept(coding("'hosp'"))),
                inner("provAffRef", ref="'Organization/h7'"),
                inner("provAffNetwork", ref="'Network/n7'"),
            ),
        ),
        "availableTime": opt(
            f"{digit} >= 4",
            "transform(sequence(1, 5), d -> named_struct('daysOfWeek', array(concat('d', d)), "
            "'availableStartTime', '08', 'availableEndTime', '17'))",
        ),
        "telecom": arr(opt("o_orderstatus = 'P'", obj(system="'email'", value="concat('r', o_orderkey, '@x.org')", use=TEXT))),
    }
    return raw_rows(
        rows, "PractitionerRole", ROLE_ID, doc, export=f"if(v = 2, '{OTHER_EXPORT}', '{EXPORT}')", version="v"
    )


def concat_id(prefix: str, value: str, suffix: str) -> str:
    return f"concat('{prefix}', {value}, '{suffix}')"


# --- Location and Organization: suppliers -----------------------------------------

TELECOM = (
    "filter(array(named_struct('system', 'phone', 'value', concat('1-', s_suppkey), 'use', 'work'), "
    "if(s_nationkey < 12, named_struct('system', 'fax', 'value', concat('2-', s_suppkey), 'use', 'work'), null), "
    "if(s_nationkey < 12, named_struct('system', 'url', 'value', concat('http://', s_suppkey), 'use', null), null)), "
    "z -> z is not null)"
)


def locations(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "name": "s_name",
        "address": obj(
            city="concat('City', s_nationkey)",
            district="'D'",
            state="concat('S', s_nationkey)",
            postalCode="concat(lpad(s_nationkey, 5, '7'), '-1234')",
            country="'US'",
            use="'work'",
            line="array('2 Main')",
        ),
        "telecom": TELECOM,
        "identifier": arr(ident("concat('PLM', s_suppkey)", "PLM"), ident("'zzz'", "OTHER")),
        "extension": arr(
            ext("http://x/officelanguage", concept=concept(coding("'en'", display="'English US'"), coding("'fr'"))),
            ext("http://x/provterm", concept=concept(coding("'PT'", display="'term'"))),
            opt("s_nationkey > 5", ext("http://x/ServiceArea", concept=concept(coding("'SA'")))),
            ext("http://x/metroarea", concept=concept(coding("'M1'", display="'metro'"), coding("'M0'"))),
        ),
        "hoursOfOperation": (
            "transform(sequence(1, 1 + s_nationkey div 5), d -> named_struct('daysOfWeek', array(concat('d', d)), "
            "'openingTime', '08', 'closingTime', '17'))"
        ),
        "position": obj(latitude="35.5", longitude="-92.25"),
    }
    rows = table(spark, folder, "supplier")
    return raw_rows(rows, "Location", "concat('loc', s_suppkey, '-loc')", doc)


def organizations(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "name": "concat('Org ', s_name)",
        "address": opt(
            "s_nationkey > 3",
            arr(
                obj(
                    use="'work'", type="'both'", text="s_name", district="'D'", state="'ST'", postalCode="'72201'",
                    country="'US'", line="array('3 Main', 'Floor 2')", period=obj(start="'2010-01-01'", end=TEXT),
                ),
                obj(
                    use="'home'", type="'postal'", text=TEXT, district=TEXT, state="'SU'", postalCode="'72202'",
                    country=TEXT, line="array('4 Main')", period=obj(start=TEXT, end=TEXT),
                ),
            ),
        ),
        "telecom": TELECOM,
        "identifier": arr(
            ident("concat('PR', s_suppkey)", "PRN"),
            ident("'N2'", "NPI"),
            ident("'N1'", "NPI"),
            ident("concat('C', s_suppkey)", "CCN"),
            ident("'TID'", "ITIN"),
            ident("'XX'", "PLAN"),
            ident("'free'"),
        ),
        "extension": arr(
            ext("http://x/licenseereference", ref="'Licensee/lic1'"),
            opt("s_nationkey > 12", ext("http://x/networkreference", ref="'Network/net2'")),
            opt("s_nationkey > 12", ext("http://x/networkreference", ref="'Network/net1'")),
        ),
    }
    return raw_rows(table(spark, folder, "supplier"), "Organization", "concat('org', s_suppkey, '-org')", doc)


# --- OrganizationAffiliation, HealthcareService, InsurancePlan, Basic: parts --------


def affiliations(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "participatingOrganization": ref(f"concat('Organization/org', p_size, '-org')"),
        "period": obj(start="'2021-01-01'", end=TEXT),
        "location": opt("p_size > 10", f"array({ref(concat_id('Location/loc', 'p_size', '-loc'))})"),
        "healthcareService": opt(
            "p_size >= 7",
            f"transform(sequence(1, p_size div 7), i -> {ref(concat_id('HealthcareService/svc', 'i', '-svc'))})",
        ),
        "identifier": arr(ident("concat('PEI', p_partkey)", "PEI"), ident("'other'", "OTH")),
        "code": arr(concept(coding("'T2'", "'http://x/BCBSProviderTypeCS'", "'Type two'"))),
        "extension": arr(
            ext("http://x/licenseereference", ref="concat('Licensee/lic', p_size div 3)"),
            ext("http://x/networkreference", ref="concat('Network/net', p_size div 5)"),
            ext(
                "http://x/details",
                inner("pcpIndicatorCode", concept=concept(coding("'Y'", display="'yes'"))),
                inner("pcpSelectabilityCode", concept=concept(coding("'S'"))),
                inner("provAffType", concept=concept(coding("'hosp'"))),
                inner("provAffRef", ref="concat('Organization/h', p_size)"),
                inner("provAffInfo", value="p_name"),
                inner("valueBasedProgramIdentifier", identifier="'VB'"),
                inner("displayIndicatorProvider", boolean="false"),
            ),
        ),
    }
    rows = table(spark, folder, "part")
    return raw_rows(rows, "OrganizationAffiliation", "concat('aff', p_partkey, '-aff')", doc)


def services(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "type": (
            "transform(sequence(1, 1 + p_size div 20), i -> named_struct('coding', array(named_struct("
            "'code', concat('t', i), 'display', concat(p_type, ' ', i)))))"
        ),
        "code": arr(concept(coding("'T3'", "'http://x/BCBSProviderTypeCS'", "'Type three'"))),
        "specialty": arr(concept(coding("p_brand", display="p_name"))),
        "extension": arr(
            ext("http://x/age", low="'1'", high="'9'"),
            ext("http://x/age", low="'0'", high="'10'"),
            ext(
                "http://x/details",
                inner("characteristics", string="'male'"),
                inner("acceptingPatients", concept=concept(coding("'existing'"))),
            ),
        ),
    }
    return raw_rows(table(spark, folder, "part"), "HealthcareService", "concat('svc', p_partkey, '-svc')", doc)


def plans(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "name": "p_name",
        "administeredBy": ref("concat('Organization/', p_brand)"),
        "network": f"transform(sequence(1, p_size div 20), i -> {ref(concat_id('Network/net', 'i', ''))})",
        "type": arr(
            concept(
                coding("p_type", "'http://x/BCBSProgramAffiliationTypeCS'", "lower(p_type)"),
                coding("p_brand", "'http://x/BCBSProductTypeCS'"),
            )
        ),
        "extension": arr(ext("http://x/memprefix", string="concat('M', p_size)"), ext("http://x/z")),
    }
    return raw_rows(table(spark, folder, "part"), "InsurancePlan", "concat('plan', p_partkey, '-plan')", doc)


def measures(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "code": concept(coding("p_type", "'http://x/QualityRecognitionTypeCS'", "p_name")),
        "identifier": arr(ident("concat('MI', p_partkey)", "PLM")),
        "extension": arr(
            ext(
                "http://x/m1",
                inner("http://x/zScore", decimal="cast(p_size as decimal(10,2)) / 4"),
                inner("http://x/decile", integer="p_size"),
                inner("http://x/recognitionPeriod", start="'2020'", end=TEXT),
                inner("http://x/licensee", ref="'Organization/lic9'"),
                inner("http://x/hospitalType", concept=concept(coding("p_brand"))),
            ),
            opt("p_size > 25", ext("http://x/m2", inner("http://x/messaging", string="p_name"), inner("http://x/recognitionWebAddress", link="'http://q'"))),
            opt("p_size > 25", ext("http://x/m2", inner("http://x/messaging", string="p_name"), inner("http://x/recognitionWebAddress", link="'http://q'"))),
        ),
    }
    return raw_rows(table(spark, folder, "part"), "Basic", "concat('basic', p_partkey, '-embold')", doc)


# --- bundles -----------------------------------------------------------------------


def bundle(
    rows: DataFrame, name: str, kind: str, record: str, doc: dict[str, str], copies: str = "sequence(1, 1)"
) -> DataFrame:
    """Bundles with one entry per element of `copies` (`n`); the version is the entry number."""
    resource = {
        "id": record,
        "resourceType": f"'{kind}'",
        "meta": obj(versionId="cast(n as string)", lastUpdated="concat('2024-0', n, '-01')"),
        **doc,
    }
    entry = f"transform({copies}, n -> {obj(resource=obj(**resource))})"
    return raw_rows(rows, "Bundle", "'bundle'", {"entry": entry}, bundle=f"'{name}'")


def plan_bundles(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "name": "p_name",
        "ownedBy": ref("concat('Organization/own', p_size)"),
        "network": f"array({ref(concat_id('Network/net', 'p_size', ''))}, {ref(concat_id('Network/nex', 'p_size', ''))})",
        "identifier": arr(ident("concat('x/pl', p_partkey)", label="p_brand")),
        "type": arr(
            concept(
                coding("p_type", "'http://x/BCBSProductTypeCS'", "concat('v', n)"),
                coding("'PA'", "'http://x/BCBSProgramAffiliationTypeCS'", "'prog'"),
            )
        ),
        "extension": arr(opt("p_size > 30", ext("http://x/memprefix", string="concat('M', p_size)"))),
    }
    copies = "if(p_size > 40, array(1, 3, 2), array(1))"
    return bundle(table(spark, folder, "part"), "InsurancePlan", "InsurancePlan", "concat('ip', p_partkey)", doc, copies)


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that reference bundles are made from; a nation's network is its own."""
    return table(spark, folder, "nation").withColumn("n_net", F.col("n_nationkey"))


# As many areas as customers; a third of them belong to network 0 of licensee 0.
MANY_AREAS = """
(select c_custkey as n_nationkey, c_name as n_name, c_nationkey % 5 as n_regionkey,
   case when c_custkey % 3 = 0 then 0 else c_custkey end as n_net from customer)
"""


def many_areas(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.selectExpr(
        "c_custkey as n_nationkey",
        "c_name as n_name",
        "c_nationkey % 5 as n_regionkey",
        "if(c_custkey % 3 = 0, 0, c_custkey) as n_net",
    )


def licensee_bundles(spark: SparkSession, folder: str, made_from=areas) -> DataFrame:
    doc = {
        "identifier": arr(
            ident("lpad(n_nationkey, 3, '0')", "PLAN", label="concat('Plan of ', n_name)"),
            ident("concat('H', n_nationkey)", "LHC"),
            ident("concat('L', n, '-', n_nationkey)", "LEC", label="'entity'"),
        )
    }
    rows = made_from(spark, folder)
    return bundle(rows, "Licensee", "Organization", "concat('lic', n_nationkey)", doc, "array(2, 1)")


def network_bundles(spark: SparkSession, folder: str, made_from=areas) -> DataFrame:
    """Two products per network, one of them listed twice; product ids repeat in pairs."""
    doc = {
        "partOf": ref("concat('Organization/lic', n_net)"),
        "identifier": arr(
            ident("concat('PN', n_nationkey)", start="'2000-01-01'", end="if(n_regionkey > 1, '2030-12-31', '2010-12-31')", label="n_name")
        ),
        "extension": arr(
            ext(
                "http://x/products",
                inner("http://x/productCode", concept=concept(coding("'PC1'", display="concat('one v', n)"))),
                inner("http://x/productCode", concept=concept(coding("'PC2'", display="'two'"), coding("'PC2'", display="'two'"))),
                inner("http://x/provProdType", concept=concept(coding("'PT'", display="'prod type'"))),
                inner("http://x/provPgmType", concept=concept(coding("concat('G', n_regionkey)", display="'pgm'"))),
            )
        ),
    }
    rows = made_from(spark, folder)
    return bundle(rows, "Network", "Organization", "concat('net', n_net)", doc, "array(1, 2)")


def system_bundles(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "name": "concat(s_name, ' v', n)",
        "address": arr(obj(city="concat('City', s_nationkey)", state="'AR'")),
        "identifier": arr(ident("concat('HS', s_suppkey)", "HSI")),
    }
    rows = table(spark, folder, "supplier")
    return bundle(rows, "HealthcareSystem", "Organization", "concat('hs', s_suppkey)", doc, "array(3, 1, 2)")


def zip_bundles(spark: SparkSession, folder: str, made_from=areas) -> DataFrame:
    doc = {
        "extension": arr(
            ext("zipCode", code="lpad(n_nationkey, 5, '7')"),
            ext("longitude", code="'-92.1'"),
            ext("latitude", code="'34.7'"),
            ext("cityName", code="concat('City', n_nationkey)"),
            ext("countyCode", concept=concept(coding("concat('0', n_nationkey)", display="concat('County ', n_name, ' v', n)"))),
            ext("stateFipsCode", code="'05'"),
            ext("cbsaCode", concept=concept(coding("'C9'"))),
            ext("stateCode", concept=concept(coding("concat('S', n_nationkey)", display="n_name"))),
        )
    }
    rows = made_from(spark, folder)
    return bundle(rows, "StateCountyZipCode", "Basic", "concat('zip', n_nationkey)", doc, "array(1, 2)")


def entity_bundles(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "code": concept(coding("if(c_nationkey > 12, 'add', 'update')")),
        "extension": arr(
            ext("planCode", code="c_mktsegment"),
            ext("group", inner("vbpId", code="concat('vb', c_custkey)"), inner("cycleId", code="'cy'")),
            ext("peiCode", concept=concept(coding("'pe'", display="c_name"))),
            ext("peiIdEffectivePeriod", start="concat('2020-01-0', n)", end="'soon'"),
        ),
    }
    copies = "if(c_acctbal > 0, array(1, 2), array(1))"
    rows = table(spark, folder, "customer")
    return bundle(rows, "ProviderEntityIdentifier", "Basic", "concat('pe', c_custkey)", doc, copies)


def program_bundles(spark: SparkSession, folder: str) -> DataFrame:
    doc = {
        "code": concept(coding("'act'")),
        "extension": arr(
            ext("planCode", code="p_brand"),
            ext("vbpId", code="concat('vb', p_partkey)"),
            ext(
                "group",
                inner("vbpProgramTypeCode", code="p_type"),
                inner("vbpScopeCode", code="'sc'"),
                inner("totalCareEffectivePeriod", start="'2021-02-03'", end="'2022-02-03T00:00:00Z'"),
            ),
            ext("vbpProgramName", code="p_name"),
            ext("vbpEffectivePeriod", start="'2019-01-01'", end=TEXT),
            ext("deDesignationDate", date="if(p_size > 25, '2023-05-06', 'n/a')"),
        ),
    }
    rows = table(spark, folder, "part")
    return bundle(rows, "ValueBasedProgramIdentifier", "Basic", "concat('vp', p_partkey)", doc)
