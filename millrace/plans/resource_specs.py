"""What each provider resource contributes, as data for `plans.resources`."""

from __future__ import annotations

from collections.abc import Sequence

from millrace.functions.nested import (
    best,
    concatenated,
    elements,
    entry,
    joined_set,
    looked_up,
    mapped,
    one_of,
    packed,
    pairs,
    quoted,
    squeeze,
    strip_blanks,
    tagged,
    tagged_values,
    tail,
)
from millrace.plans.resources import Resource, Shape

# --- parts of the JSON schemas -------------------------------------------------

CODING = "struct<system:string,code:string,display:string>"
CONCEPT = f"struct<coding:array<{CODING}>>"
PERIOD = "struct<start:string,end:string>"
REFERENCE = "struct<reference:string>"
META = "id:string,meta:struct<versionId:string,lastUpdated:string>"
IDENTIFIER = f"array<struct<value:string,type:{CONCEPT},period:{PERIOD}>>"
CONCEPTS = f"array<{CONCEPT}>"
REFERENCES = f"array<{REFERENCE}>"
TELECOM = "array<struct<system:string,value:string,use:string>>"
INNER_EXTENSION = (
    "struct<url:string,value:string,valueString:string,valueBoolean:string,valueInteger:string,"
    f"valueDecimal:string,valueUrl:string,valueReference:{REFERENCE},valuePeriod:{PERIOD},"
    f"valueIdentifier:struct<value:string>,valueCodeableConcept:{CONCEPT}>"
)


def extensions(outer: Sequence[str], inner: Sequence[str]) -> str:
    """Outer extensions with these fields and inner ones with a url and these.

    Every field of every object costs time to parse, also where it is absent, so only those read are listed.
    Small objects of texts are maps (read by `entry`): that spares what a struct costs for each of them.
    """
    return f"array<struct<{','.join(outer)},extension:array<struct<{','.join(('url:string', *inner))}>>>>"


# the codings of an outer extension stay variants, parsed once: one column wants them whole
CODED = "valueCodeableConcept:struct<coding:array<variant>>"
EXTENSION = f"array<struct<url:string,valueString:string,valueBoolean:string,valueReference:{REFERENCE},{CODED}>>"
TEXTS = "map<string,string>"
RANGE = f"valueRange:struct<low:{TEXTS},high:{TEXTS}>"
ROLE_OUTER_FIELDS = ("url:string", "valueBoolean:string", f"valueReference:{TEXTS}", CODED)
ROLE_INNER_FIELDS = (
    "valueString:string",
    "valueBoolean:string",
    f"valueReference:{TEXTS}",
    f"valuePeriod:{TEXTS}",
    f"valueIdentifier:{TEXTS}",
)
CODES = "valueCodeableConcept:struct<coding:array<struct<code:string>>>"
LABELS = "valueCodeableConcept:struct<coding:array<struct<code:string,display:string>>>"

# --- fixed values: code systems, identifier kinds, extension tags --------------

# code systems by the last part of their address
CODE_SYSTEMS = {
    "taxonomy": "provider-taxonomy",
    "provider type": "BCBSProviderTypeCS",
    "entity type": "BCBSProviderEntityTypeCS",
    "program affiliation": "BCBSProgramAffiliationTypeCS",
    "product type": "BCBSProductTypeCS",
    "recognition": "QualityRecognitionTypeCS",
    "termination reason": "BCBSProviderTerminationReasonCS",
}
PERSON_TAX_CODES = ["SS", "TAX", "ITIN", "EN"]
ORGANIZATION_TAX_CODES = ["SS", "TAX", "ITIN"]
KNOWN_ORGANIZATION_CODES = ["PRN", "PRM", "NPI", "CCN", "SS", "TAX", "ITIN", "PCRN"]


def ddl(*fields: str) -> str:
    """A from_json schema out of `name:type` lists."""
    return f"struct<{','.join((META, *fields))}>"


# --- recurring branches --------------------------------------------------------

IDS = pairs(
    "doc.identifier",
    "i",
    "i.type.coding",
    "c",
    packed(value="i.value", code="c.code", start="i.period.start", end="i.period.end"),
)

# one entry per (outer extension, JSON coding)
OUTER = pairs(
    "doc.extension",
    "x",
    "x.valueCodeableConcept.coding",
    "c",
    packed(
        tag=tail("x.url"),
        valueString="x.valueString",
        valueBoolean="x.valueBoolean",
        reference=tail("x.valueReference.reference"),
        system="try_variant_get(c, '$.system', 'string')",
        code="try_variant_get(c, '$.code', 'string')",
        display="try_variant_get(c, '$.display', 'string')",
    ),
)

# role-like documents: inner extensions of all outer ones, the tags of the outer ones, their codings
MARKS = "flatten(array_compact(doc.extension.extension))"
TAGS = f"transform(doc.extension, x -> {tail('x.url')})"
CODINGS = "flatten(array_compact(doc.extension.valueCodeableConcept.coding))"


def lacking(child: str) -> str:
    """Whether some outer extension has no `child` elements, or there is none at all: an outer flatten gives a NULL element."""
    return f"(not coalesce(size(doc.extension) > 0, false) or exists(doc.extension, x -> not coalesce(size(x.{child}) > 0, false)))"


LABELLED = concatenated("e.code", "':'", "coalesce(e.display, '')")


def codings(array: str) -> str:
    """(code, display, system, last part of the system) of every coding of a concept list."""
    return pairs(
        array,
        "q",
        "q.coding",
        "c",
        packed(code="c.code", display="c.display", system="c.system", kind=tail("c.system")),
    )


def id_column(codes: list[str], part: str = "value", default: str | None = "") -> str:
    return tagged("ids", one_of("e.code", codes), f"e.{part}", default)


def by_tag(tag: str, value: str, default: str | None = "") -> str:
    """From the outer extension whose url ends in `tag`."""
    return tagged("ext", f"e.tag = '{tag}'", value, default)


def of_extension(tag: str, value) -> str:
    """`value` of the outer extension (of a role-like document) whose url ends in `tag`."""
    return looked_up("doc.extension", "tags", tag, lambda x: tail(f"{x}.url"), value, "false")


def by_url(tag: str, value) -> str:
    """`value` of the inner extension with this url."""
    return looked_up("marks", "marks.url", tag, lambda x: f"{x}.url", value, lacking("extension"))


def code_of(tag: str) -> str:
    return by_url(tag, lambda x: f"array_max({x}.valueCodeableConcept.coding.code)")


def typed(branch: str, kind: str, prefix: str, parts=("code", "display", "system")) -> dict[str, str]:
    """code / display / system of the coding whose system ends in `kind`."""
    names = {"code": f"{prefix}_cd", "display": f"{prefix}_display", "system": f"{prefix}_system"}
    return {names[p]: tagged(branch, f"e.kind = '{kind}'", f"e.{p}", "") for p in parts}


def telecom_columns() -> dict[str, str]:
    out = {}
    for system in ("phone", "fax", "url"):
        for name, part in (
            (f"prov_communication_info_type_{system}", "system"),
            (f"prov_communication_info_{system}", "value"),
            (f"prov_communication_info_purpose_{system}", "use"),
        ):
            out[name] = tagged(elements("doc.telecom"), f"e.system = '{system}'", f"e.{part}", " ")
    return out


def referenced(array: str) -> str:
    """Distinct record ids of an array of references."""
    return f"array_distinct({mapped(array, 'r', tail('r.reference'))})"


SPACED = f"trim({joined_set('{}', ' ')})"

# network ids as rows; a document without any yields one empty id
NETWORK_ROWS = "if(size({0}) > 0, sort_array({0}), array(''))"
NETWORKS = (
    "filter({}, v -> v <> '')".format(
        tagged_values("ext", "e.tag = 'networkreference'", "e.reference", "")
    ),
    NETWORK_ROWS,
)
ROLE_NETWORKS = (
    "if(array_contains(tags, 'networkreference'), filter({}, v -> v <> ''), array())".format(
        tagged_values("doc.extension", f"{tail('e.url')} = 'networkreference'", tail(entry("e.valueReference", "reference")), "")
    ),
    NETWORK_ROWS,
)

PROGRAMS = (
    "transform(filter(marks, e -> e.url = 'valueBasedProgramIdentifier'), e -> coalesce({}, ' '))".format(
        entry("e.valueIdentifier", "value")
    ),
    SPACED,
)


def slot_parts(array: str, i: int, first: str, second: str, gap: str) -> str:
    slot = f"get({array}, {i})"
    return concatenated(f"get({slot}.daysOfWeek, 0)", quoted(gap), f"{slot}.{first}", "'-'", f"{slot}.{second}")


def with_separator(parts: list[str], separator: str) -> str:
    spread = [x for part in parts for x in (quoted(separator), part)][1:]
    return concatenated(*spread)


# five slots 'day:end-start'; NULL as soon as any part of any slot is missing
OFFICE_HOURS = with_separator(
    [slot_parts("doc.availableTime", i, "availableEndTime", "availableStartTime", ":") for i in range(5)], ","
)

# seven lines 'day open-close', a blank for a missing slot; NULL if a present slot lacks a part
WEEKLY_HOURS = with_separator(
    [
        f"if(get(doc.hoursOfOperation, {i}) is not null, "
        f"{slot_parts('doc.hoursOfOperation', i, 'openingTime', 'closingTime', ' ')}, ' ')"
        for i in range(7)
    ],
    "\n",
)


# --- Practitioner --------------------------------------------------------------

TAXONOMY = f"if({tail('c.system')} = '{CODE_SYSTEMS["taxonomy"]}', c.code, '')"


def with_taxonomy(other: str, value: str) -> str:
    """`taxonomy:value` per coding `c` and element `o` of another array of one qualification `q`."""
    per_qualification = pairs(
        "q.code.coding", "c", other, "o", concatenated(TAXONOMY, "':'", value)
    )
    return f"flatten({mapped('doc.qualification', 'q', per_qualification)})"


def from_issuer(code: str, part: str) -> str:
    return tagged("qual", f"e.code = '{code}'", f"e.{part}", "")


def of_name(value: str) -> str:
    return best(elements("doc.name"), value)


def of_address(value: str) -> str:
    return best(elements("doc.address"), value)


_PRACTITIONER = Shape(
    branches={
        "ids": IDS,
        "qual": pairs(
            "doc.qualification",
            "q",
            "q.code.coding",
            "c",
            packed(
                code="c.code",
                taxonomy=TAXONOMY,
                label=f"if({tail('c.system')} = '{CODE_SYSTEMS["taxonomy"]}', c.display, '')",
                issuer=tail("q.issuer.reference"),
                end="q.period.end",
            ),
        ),
    },
    tops={
        "plan_prov_id": id_column(["PRN"]),
        "national_prov_id": id_column(["NPI"]),
        "prov_master_id": id_column(["PRM"]),
        "cross_reference_plan_prov_id": id_column(["PCRN"]),
        "cross_reference_plan_prov_id_eff_dt": id_column(["PCRN"], "start"),
        "cross_reference_plan_prov_id_end_dt": id_column(["PCRN"], "end"),
        "prov_tax_id": id_column(PERSON_TAX_CODES),
        "prov_tax_id_type": id_column(PERSON_TAX_CODES, "code"),
        "prov_medical_school": from_issuer("MEDSCHL", "issuer"),
        "prov_medical_school_year": from_issuer("MEDSCHL", "end"),
        "prov_internship": from_issuer("INTERN", "issuer"),
        "prov_residency": from_issuer("RESIDEN", "issuer"),
        "prov_credential": best("qual", "e.code"),
        "prov_license_state": "array_max(flatten({}))".format(
            mapped(
                "doc.qualification",
                "q",
                "flatten({})".format(
                    mapped(
                        "q.code.extension",
                        "x",
                        pairs("x.extension", "y", "y.valueCodeableConcept.coding", "c", "c.code"),
                    )
                ),
            )
        ),
        "prov_last_name": of_name("e.family"),
        "prov_first_name": of_name("get(e.given, 0)"),
        "prov_middle_initial": of_name("get(e.given, 1)"),
        "prov_name_suffix": of_name("get(e.suffix, 0)"),
        "jobtitle": of_name("get_json_object(e.extension, '$.jobtitle')"),
        "birth_dt": "doc.birthDate",
        "prov_gender": "doc.gender",
        "active_ind": "doc.active",
        "city": of_address("e.city"),
        "country": of_address("e.country"),
        "addr_line1": of_address("get(e.line, 0)"),
        "addr_line2": of_address("get(e.line, 1)"),
        "state": of_address("e.state"),
        "type": of_address("e.type"),
        "use": of_address("e.use"),
    },
    sets={
        "plan_prov_id_type_list": ("transform(ids, e -> coalesce(e.code, ''))", SPACED),
        "taxonomy_cd": ("transform(qual, e -> coalesce(e.taxonomy, ''))", squeeze(SPACED)),
        "taxonomy_desc": (
            tagged_values(
                "qual", "e.taxonomy <> ''", concatenated("e.taxonomy", "':'", "coalesce(e.label, '')", "'\\n'"), ""
            ),
            squeeze(joined_set("{}", "")),
        ),
        "board_certification_ind": (
            with_taxonomy(
                "q.code.extension",
                f"if({tail('o.url')} = 'boardcertificationindicator', o.valueBoolean, '')",
            ),
            squeeze(joined_set("{}", "||")),
        ),
        "board_certification_issuing_organization": (
            with_taxonomy(
                "q.extension", f"if(o.valueCode = 'boardcert', {tail('q.issuer.reference')}, '')"
            ),
            squeeze(joined_set("{}", "||")),
        ),
        "communication": (
            pairs(
                "doc.communication",
                "m",
                "m.coding",
                "c",
                f"coalesce({concatenated('c.code', quoted(' : '), 'c.display')}, ' ')",
            ),
            strip_blanks(f"trim({joined_set('{}', chr(10))})"),
        ),
    },
)

PRACTITIONER = Resource(
    kind="Practitioner",
    schema=ddl(
        "birthDate:string",
        "gender:string",
        "active:string",
        f"identifier:{IDENTIFIER}",
        "name:array<struct<family:string,given:array<string>,suffix:array<string>,extension:string>>",
        "address:array<struct<city:string,country:string,state:string,type:string,use:string,line:array<string>>>",
        f"communication:{CONCEPTS}",
        f"qualification:array<struct<issuer:{REFERENCE},period:{PERIOD},"
        f"code:struct<coding:array<{CODING}>,extension:array<struct<url:string,valueBoolean:string,"
        f"extension:array<struct<valueCodeableConcept:{CONCEPT}>>>>>,"
        "extension:array<struct<valueCode:string>>>>",
    ),
    shape=_PRACTITIONER,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts plan_prov_id_type_list plan_prov_id "
        "national_prov_id prov_master_id cross_reference_plan_prov_id cross_reference_plan_prov_id_eff_dt "
        "cross_reference_plan_prov_id_end_dt prov_tax_id prov_tax_id_type taxonomy_cd taxonomy_desc "
        "prov_medical_school prov_medical_school_year prov_internship prov_residency board_certification_ind "
        "board_certification_issuing_organization prov_credential prov_license_state prov_last_name "
        "prov_first_name prov_middle_initial prov_name_suffix jobtitle birth_dt prov_gender active_ind "
        "communication city country addr_line1 addr_line2 state type use profile_type load_dt"
    ).split(),
)

# --- PractitionerRole and OrganizationAffiliation ------------------------------


ROLE_BRANCHES = {"marks": MARKS, "tags": TAGS, "codings": CODINGS, "codes": codings("doc.code")}


def affiliation_ref(tag: str) -> str:
    return by_url(tag, lambda x: tail(entry(f"{x}.valueReference", "reference")))


# the largest bounds of all age ranges, compared as numbers and printed without trailing zeros
AGE_COLUMNS = {"patient_age_range_high": "high", "patient_age_range_low": "low"}
AGE_TOPS = {
    name: "array_max(transform(filter(doc.extension.valueRange.{}, r -> size(r) > 0), r -> try_cast({} as decimal(38,10))))".format(
        bound, entry("r", "value")
    )
    for name, bound in AGE_COLUMNS.items()
}
AGE_FINALS = {name: f"regexp_replace(cast({name} as string), '[.]?0+$', '')" for name in AGE_COLUMNS}
_TERMINATION = tagged(
    "codings",
    f"{tail("try_variant_get(e, '$.system', 'string')")} = '{CODE_SYSTEMS['termination reason']}'",
    "try_variant_get(e, '$.code', 'string')",
    "",
)

# MAX columns both role-like resources share
ROLE_TOPS = {
    "licensee_ref_record_id": of_extension("licenseereference", lambda x: tail(entry(f"{x}.valueReference", "reference"))),
    **typed("codes", CODE_SYSTEMS["provider type"], "prov_type"),
    **typed("codes", CODE_SYSTEMS["entity type"], "prov_entity_type"),
    "prov_eff_dt": "doc.period.start",
    "prov_term_dt": "doc.period.end",
    "pcp_eff_dt": by_url("pcpEffectivePeriod", lambda x: entry(f"{x}.valuePeriod", "start")),
    "pcp_end_dt": by_url("pcpEffectivePeriod", lambda x: entry(f"{x}.valuePeriod", "end")),
    "pcp_selectability_cd": code_of("pcpSelectabilityCode"),
    "prov_reimbursement_cd": code_of("providerReimbursementCode"),
    "prov_termination_cd": f"coalesce({_TERMINATION}, if({lacking('valueCodeableConcept.coding')}, '', null))",
    "days_of_week_and_office_hours": OFFICE_HOURS,
    "prov_accepts_member_select_attrib_ind": by_url(
        "providerAcceptsMemberSelectAttributionIndicator", lambda x: f"{x}.valueBoolean"
    ),
    "display_ind_prov": by_url("displayIndicatorProvider", lambda x: f"{x}.valueBoolean"),
    "display_suppression_reason_prov": code_of("displaySuppressionReasonProvider"),
    "prov_contract_status": of_extension("provcontract", lambda x: f"{x}.valueBoolean"),
    "tier_designation_cd": of_extension(
        "provtierdesig",
        lambda x: f"array_max(transform({x}.valueCodeableConcept.coding, c -> nullif(to_json(c), 'null')))",
    ),
}

_PRACTITIONER_ROLE = Shape(
    branches={**ROLE_BRANCHES, "specialties": codings("doc.specialty")},
    tops={
        **ROLE_TOPS,
        "organization_ref_record_id": tail("doc.organization.reference"),
        "prov_entity_id": "array_max(doc.identifier.value)",
        **AGE_TOPS,
        "prov_patient_gender_limit": by_url("characteristics", lambda x: f"{x}.valueString"),
        "accepting_new_patients_cd": code_of("acceptingPatients"),
        "pcp_ind_cd": code_of("pcpIndicatorCode"),
        "specialty_cd": best("specialties", "e.code"),
        "specialty_display": best("specialties", "e.display"),
        "specialty_system": best("specialties", "e.system"),
        "prov_affil_type": code_of("provAffType"),
        "prov_affil_ref": affiliation_ref("provAffRef"),
        "prov_affil_network": affiliation_ref("provAffNetwork"),
    },
    sets={"network_ref_record_id": ROLE_NETWORKS, "value_based_program_id": PROGRAMS},
    unfold={
        "location_ref_record_id": referenced("doc.location"),
        "healthcare_service_ref_record_id": referenced("doc.healthcareService"),
    },
    doc_keys={
        "last_updtd_ts": "doc.meta.lastUpdated",
        "practitioner_ref_record_id": tail("doc.practitioner.reference"),
    },
    keys={
        "location_ref_record_id": "location_ref_record_id",
        "healthcare_service_ref_record_id": "healthcare_service_ref_record_id",
    },
    finals=AGE_FINALS,
    rows_from="network_ref_record_id",
)


_ROLE_FIELDS = (
    f"location:{REFERENCES}",
    f"healthcareService:{REFERENCES}",
    f"code:{CONCEPTS}",
    f"period:{PERIOD}",
    "availableTime:array<struct<daysOfWeek:array<string>,availableStartTime:string,availableEndTime:string>>",
)

PRACTITIONER_ROLE = Resource(
    kind="PractitionerRole",
    schema=ddl(
        f"practitioner:{REFERENCE}",
        f"organization:{REFERENCE}",
        f"specialty:{CONCEPTS}",
        "identifier:array<struct<value:string>>",
        f"extension:{extensions([*ROLE_OUTER_FIELDS, RANGE], [*ROLE_INNER_FIELDS, CODES])}",
        *_ROLE_FIELDS,
    ),
    shape=_PRACTITIONER_ROLE,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts organization_ref_record_id "
        "practitioner_ref_record_id licensee_ref_record_id network_ref_record_id location_ref_record_id "
        "healthcare_service_ref_record_id prov_entity_id prov_type_cd prov_type_display prov_type_system "
        "prov_entity_type_cd prov_entity_type_display prov_entity_type_system patient_age_range_high "
        "patient_age_range_low prov_patient_gender_limit prov_eff_dt prov_term_dt accepting_new_patients_cd "
        "value_based_program_id pcp_ind_cd pcp_eff_dt pcp_end_dt pcp_selectability_cd prov_reimbursement_cd "
        "prov_termination_cd specialty_cd specialty_display specialty_system days_of_week_and_office_hours "
        "prov_accepts_member_select_attrib_ind display_ind_prov display_suppression_reason_prov "
        "prov_contract_status prov_affil_type prov_affil_ref prov_affil_network tier_designation_cd "
        "profile_type load_dt"
    ).split(),
    latest_by=("file_record_id",),
)

# the last service index an affiliation keeps
LAST_SERVICE_INDEX = 4


_ORG_AFFILIATION = Shape(
    branches={**ROLE_BRANCHES, "ids": IDS},
    tops={
        **ROLE_TOPS,
        "participating_organization_ref_record_id": tail("doc.participatingOrganization.reference"),
        "prov_entity_id": id_column(["PEI"]),
        "pcp_ind_cd": by_url(
            "pcpIndicatorCode",
            lambda x: f"array_max(transform({x}.valueCodeableConcept.coding, c -> concat(c.code, ':', coalesce(c.display, ''))))",
        ),
        "affiliation_kind": code_of("provAffType"),
        "affiliation_ref": affiliation_ref("provAffRef"),
        "affliation_desc": by_url("provAffInfo", lambda x: f"{x}.value"),
        "healthcare_system_name": "''",
        "healthcare_system_city": "''",
        "healthcare_system_state": "''",
    },
    sets={"network_ref_record_id": ROLE_NETWORKS, "value_based_program_id_list": PROGRAMS},
    unfold={"location_ref_record_id": referenced("doc.location")},
    unfold_only={
        "healthcare_service_ref_record_id": (
            f"array_distinct(transform(slice(doc.healthcareService, 1, {LAST_SERVICE_INDEX + 1}), "
            f"r -> {tail('r.reference')}))"
        )
    },
    keys={
        "location_ref_record_id": "location_ref_record_id",
        "healthcare_service_ref_record_id": "healthcare_service_ref_record_id",
    },
    finals={"prov_affliation_type": concatenated("affiliation_kind", "':'", "affiliation_ref")},
    rows_from="network_ref_record_id",
)


ORG_AFFILIATION = Resource(
    kind="OrganizationAffiliation",
    schema=ddl(
        f"participatingOrganization:{REFERENCE}",
        f"identifier:{IDENTIFIER}",
        f"extension:{extensions(ROLE_OUTER_FIELDS, ['value:string', *ROLE_INNER_FIELDS, LABELS])}",
        *_ROLE_FIELDS,
    ),
    shape=_ORG_AFFILIATION,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts network_ref_record_id licensee_ref_record_id "
        "healthcare_service_ref_record_id location_ref_record_id participating_organization_ref_record_id "
        "prov_type_cd prov_type_display prov_type_system prov_entity_type_cd prov_entity_type_display "
        "prov_entity_type_system prov_eff_dt prov_term_dt pcp_ind_cd pcp_eff_dt pcp_end_dt "
        "prov_reimbursement_cd prov_termination_cd pcp_selectability_cd days_of_week_and_office_hours "
        "value_based_program_id_list prov_accepts_member_select_attrib_ind prov_entity_id tier_designation_cd "
        "prov_contract_status display_ind_prov display_suppression_reason_prov prov_affliation_type "
        "affliation_desc healthcare_system_name healthcare_system_city healthcare_system_state profile_type load_dt"
    ).split(),
)

# --- Location ------------------------------------------------------------------


_LOCATION = Shape(
    branches={"ids": IDS, "ext": OUTER},
    tops={
        "provider_location_master_identifier": id_column(["PLM"]),
        "prov_dba_name": "doc.name",
        "prov_addr_city": "doc.address.city",
        "prov_addr_district": "doc.address.district",
        "prov_addr_state": "doc.address.state",
        "prov_addr_postalcd": "doc.address.postalCode",
        "prov_addr_country": "doc.address.country",
        "prov_addr_use": "doc.address.use",
        "prov_addr_line1": "get(doc.address.line, 0)",
        "prov_addr_line2": "get(doc.address.line, 1)",
        **telecom_columns(),
        "days_of_week_and_office_hours": WEEKLY_HOURS,
        "position_latitude": "doc.position.latitude",
        "position_longitude": "doc.position.longitude",
        "prov_termination_cd": by_tag("provterm", LABELLED, None),
        "service_area_cd": tagged("ext", "lower(e.tag) = 'servicearea'", LABELLED),
        "geocoding_return_cd": tagged("ext", "lower(e.tag) = 'geocodereturn'", LABELLED),
        "metropolitan_statistical_area": tagged("ext", "lower(e.tag) = 'metroarea'", LABELLED),
    },
    sets={
        "prov_staff_language": (
            "transform({}, v -> coalesce(v, ''))".format(
                tagged_values("ext", "e.tag = 'officelanguage'", LABELLED)
            ),
            strip_blanks(f"trim({joined_set('{}', chr(10))})"),
        )
    },
)

LOCATION = Resource(
    kind="Location",
    schema=ddl(
        "name:string",
        "address:struct<city:string,district:string,state:string,postalCode:string,country:string,"
        "use:string,line:array<string>>",
        f"telecom:{TELECOM}",
        f"identifier:{IDENTIFIER}",
        f"extension:{EXTENSION}",
        "hoursOfOperation:array<struct<daysOfWeek:array<string>,openingTime:string,closingTime:string>>",
        "position:struct<latitude:string,longitude:string>",
    ),
    shape=_LOCATION,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts provider_location_master_identifier "
        "prov_dba_name prov_addr_city prov_addr_district prov_addr_state prov_addr_postalcd prov_addr_country "
        "prov_addr_use prov_addr_line1 prov_addr_line2 prov_communication_info_type_phone "
        "prov_communication_info_phone prov_communication_info_purpose_phone prov_communication_info_type_fax "
        "prov_communication_info_fax prov_communication_info_purpose_fax prov_communication_info_type_url "
        "prov_communication_info_url prov_communication_info_purpose_url days_of_week_and_office_hours "
        "position_latitude position_longitude prov_staff_language prov_termination_cd service_area_cd "
        "geocoding_return_cd metropolitan_statistical_area profile_type load_dt"
    ).split(),
)

# --- Organization --------------------------------------------------------------


_ORGANIZATION = Shape(
    branches={"ids": IDS, "ext": OUTER},
    tops={
        "prov_organization_name": "doc.name",
        "plan_prov_id": id_column(["PRN"], default=None),
        "prov_master_id": id_column(["PRM"], default=None),
        "cms_certification_number": id_column(["CCN"], default=None),
        "prov_tax_id": id_column(ORGANIZATION_TAX_CODES),
        "prov_tax_id_type": id_column(ORGANIZATION_TAX_CODES, "code"),
        "cross_reference_plan_prov_id": id_column(["PCRN"]),
        "cross_reference_plan_prov_id_eff_dt": id_column(["PCRN"], "start"),
        "cross_reference_plan_prov_id_end_dt": id_column(["PCRN"], "end"),
        "other_plan_prov_id": tagged(
            "ids", f"e.code is null or not {one_of('e.code', KNOWN_ORGANIZATION_CODES)}", "e.value"
        ),
        **telecom_columns(),
        "licensee_entity_cd": id_column(["LEC"], default=None),
        "plan_cd": id_column(["PLAN"], default=None),
        "licensee_hierarchy_cd": id_column(["LHC"], default=None),
        "licensee_ref_record_id": by_tag("licenseereference", "e.reference"),
    },
    sets={
        "national_prov_id_list": (
            "transform({}, v -> coalesce(v, ''))".format(
                tagged_values("ids", "e.code = 'NPI'", "e.value")
            ),
            SPACED,
        ),
        "network_ref_record_id": NETWORKS,
    },
    unfold={"place": elements("doc.address")},
    keys={"prov_addr_use": "place.use"},
    late_tops={
        "prov_addr_type": "place.type",
        "prov_addr_district": "place.district",
        "prov_addr_state": "place.state",
        "prov_addr_postal_cd": "place.postalCode",
        "prov_addr_country": "place.country",
        "prov_addr_text": "place.text",
        "prov_addr_line1": "get(place.line, 0)",
        "prov_addr_line2": "get(place.line, 1)",
        "prov_addr_start": "place.period.start",
        "prov_addr_end": "place.period.end",
    },
    rows_from="network_ref_record_id",
)

ORGANIZATION = Resource(
    kind="Organization",
    schema=ddl(
        "name:string",
        "address:array<struct<type:string,use:string,text:string,district:string,state:string,"
        f"postalCode:string,country:string,line:array<string>,period:{PERIOD}>>",
        f"telecom:{TELECOM}",
        f"identifier:{IDENTIFIER}",
        f"extension:{EXTENSION}",
    ),
    shape=_ORGANIZATION,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts prov_organization_name plan_prov_id "
        "prov_master_id national_prov_id_list cms_certification_number prov_tax_id prov_tax_id_type "
        "cross_reference_plan_prov_id cross_reference_plan_prov_id_eff_dt cross_reference_plan_prov_id_end_dt "
        "other_plan_prov_id prov_addr_type prov_addr_district prov_addr_state prov_addr_postal_cd "
        "prov_addr_country prov_addr_use prov_addr_text prov_addr_line1 prov_addr_line2 prov_addr_start "
        "prov_addr_end prov_communication_info_type_phone prov_communication_info_phone "
        "prov_communication_info_purpose_phone prov_communication_info_type_fax prov_communication_info_fax "
        "prov_communication_info_purpose_fax prov_communication_info_type_url prov_communication_info_url "
        "prov_communication_info_purpose_url licensee_entity_cd plan_cd licensee_hierarchy_cd profile_type "
        "network_ref_record_id licensee_ref_record_id load_dt"
    ).split(),
)

# --- HealthcareService and InsurancePlan ---------------------------------------


_HEALTHCARE_SERVICE = Shape(
    branches={
        "marks": MARKS,
        "codes": codings("doc.code"),
        "specialties": codings("doc.specialty"),
    },
    tops={
        **typed("codes", CODE_SYSTEMS["provider type"], "prov_type", ("code", "display")),
        **AGE_TOPS,
        "prov_patient_gender_limit": by_url("characteristics", lambda x: f"{x}.valueString"),
        "accepting_new_patients_cd": code_of("acceptingPatients"),
        "specialty_cd": best("specialties", "e.code"),
        "specialty_display": best("specialties", "e.display"),
    },
    unfold={"service": codings("doc.type")},
    keys={"healthcare_service_type_cd": "service.code"},
    late_tops={"healthcare_service_type": "service.display"},
    finals=AGE_FINALS,
)

HEALTHCARE_SERVICE = Resource(
    kind="HealthcareService",
    schema=ddl(f"type:{CONCEPTS}", f"code:{CONCEPTS}", f"specialty:{CONCEPTS}", f"extension:{extensions([RANGE], ['valueString:string', CODES])}"),
    shape=_HEALTHCARE_SERVICE,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts healthcare_service_type_cd "
        "healthcare_service_type prov_type_cd prov_type_display patient_age_range_high patient_age_range_low "
        "prov_patient_gender_limit accepting_new_patients_cd specialty_cd specialty_display profile_type load_dt"
    ).split(),
)



def by_type(kind: str, part: str) -> str:
    return tagged("types", f"e.kind = '{kind}'", f"e.{part}", "")


_INSURANCE_PLAN = Shape(
    branches={"types": codings("doc.type")},
    tops={
        "administered_by_ref_record_id": tail("doc.administeredBy.reference"),
        "descriptive_product_name": "doc.name",
        "program_affil_type_cd": by_type(CODE_SYSTEMS["program affiliation"], "code"),
        "program_affil_type": by_type(CODE_SYSTEMS["program affiliation"], "display"),
        "bcbs_product_type_cd": by_type(CODE_SYSTEMS["product type"], "code"),
        "bcbs_product_type": by_type(CODE_SYSTEMS["product type"], "display"),
        "memprefix": tagged(
            elements("doc.extension"), f"{tail('e.url')} = 'memprefix'", "e.valueString", ""
        ),
    },
    unfold={"network_ref_record_id": referenced("doc.network")},
    keys={"network_ref_record_id": "network_ref_record_id"},
)

INSURANCE_PLAN = Resource(
    kind="InsurancePlan",
    schema=ddl(
        "name:string",
        f"administeredBy:{REFERENCE}",
        f"network:{REFERENCES}",
        f"type:{CONCEPTS}",
        "extension:array<struct<url:string,valueString:string>>",
    ),
    shape=_INSURANCE_PLAN,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts administered_by_ref_record_id "
        "network_ref_record_id descriptive_product_name program_affil_type_cd program_affil_type "
        "bcbs_product_type_cd bcbs_product_type memprefix profile_type load_dt"
    ).split(),
)

# --- Basic: quality measures ---------------------------------------------------

# Measure tags by the JSON field that carries them, and the output
# column of each tag.
MEASURE_TAGS = {
    "coding": {
        "recognitionType": "recognition_type",
        "recognitionValue": "recognition_value",
        "recognizingEntity": "recognition_entity",
        "hospitalOwner": "hospital_owner",
        "hospitalType": "hospital_type",
        "emergencyService": "emergency_service",
    },
    "valueUrl": {
        "recognitionWebAddress": "recognition_webaddr",
    },
    "valueString": {
        "hcahpsMeasureCode": "hcahps_measure_cd",
        "measureCode": "measure_cd",
        "hcahpsAnswerPercent": "hcahps_answer_percent",
        "hospitalSurveyResponseRateFootnote": "hospital_survey_response_rate_footnote",
        "surveyResponseRatePercent": "survey_response_rate_percent",
        "numberOfSurveys": "number_of_surveys",
        "alternativeRating": "alt_rating",
        "numberOfHospitalsAtAlternativeRatingBenchmark": "number_of_hospitals_at_alt_rating_benchmark",
        "messaging": "messaging",
        "scoreDesignation": "score_designation",
        "emboldMarket": "embold_mkt",
        "emboldSpecialty": "embold_specialty",
        "emboldStatus": "embold_status",
        "emboldAccount": "embold_accnt",
        "emboldTier": "embold_tier",
    },
    "valueDecimal": {
        "zScore": "zscore",
        "weightedPerformanceScore": "weighted_performance_score",
        "unweightedPerformanceScore": "unweighted_performance_score",
        "severityIndex": "severity_index",
    },
    "valueInteger": {
        "decile": "decile",
        "starRating": "star_rating",
        "linearMean": "linear_mean",
        "processMeasureSample": "process_measure_sample",
        "observedRateOfOccurrences": "observed_rate_of_occurrences",
        "confidenceIntervalValueLow": "confidence_interval_value_low",
        "confidenceIntervalValueHigh": "confidence_interval_value_high",
        "atRiskPatients": "at_risk_patients",
        "observedCases": "observed_cases",
        "expectedCases": "expected_cases",
        "quintileValue": "quintile_value",
        "riskAdjustedRate": "risk_adjusted_rate",
        "stateLowCutpoint": "state_low_cutpoint",
        "stateMediumCutpoint": "state_medium_cutpoint",
        "stateHighCutpoint": "state_high_cutpoint",
        "stateVeryHighCutpoint": "state_very_high_cutpoint",
        "stateOverallCutpoint": "state_overall_cutpoint",
        "stateAverage": "state_average",
        "stateAverageBottom20Percent": "state_average_bottom_20_percent",
        "stateAverageTop20Percent": "state_average_top_20_percent",
        "nationalLowCutpoint": "national_low_cutpoint",
        "nationalMediumCutpoint": "national_medium_cutpoint",
        "nationalHighCutpoint": "national_high_cutpoint",
        "nationalVeryHighCutpoint": "national_very_high_cutpoint",
        "nationalOverallCutpoint": "national_overall_cutpoint",
        "nationalAverage": "national_average",
        "nationalAverageBottom20Percent": "national_average_bottom_20_percent",
        "nationalAverageTop20Percent": "national_average_top20_percent",
        "differenceInObservedAndExpectedRates": "difference_in_observed_and_expected_rates",
        "achievementPointsNumerator": "achievement_points_numerator",
        "achievementPointsDenominator": "achievement_points_denominator",
        "improvementPointsNumerator": "improvement_points_numerator",
        "improvementPointsDenominator": "improvement_points_denominator",
        "conditionProcedureScore": "condition_procedures_core",
        "measureDimensionScoreNumerator": "measure_dim_score_numerator",
        "measureDimensionScoreDenominator": "measure_dim_score_denominator",
        "processMeasureScore": "process_measure_score",
    },
}


def measure_columns() -> list[tuple[str, str, str]]:
    """(carrier, tag, output column) of every measure."""
    return [(carrier, tag, name) for carrier, tags in MEASURE_TAGS.items() for tag, name in tags.items()]


def by_measure(tag: str, value: str) -> str:
    return tagged("inner", f"e.tag = '{tag}'", value, "")


def recognized_by(part: str) -> str:
    return tagged(elements("doc.code.coding"), f"{tail('e.system')} = '{CODE_SYSTEMS["recognition"]}'", f"e.{part}", "")


_BASIC = Shape(
    branches={"ids": IDS},
    tops={
        "quality_recognition_type_cd": recognized_by("code"),
        "quality_recognition_type_display": recognized_by("display"),
        "master_id": best("ids", "e.value"),
        "master_id_type": best("ids", "e.code"),
    },
    # each measure is one outer extension; equal ones (as canonical JSON) are one key
    unfold={
        "measure": f"array_distinct({mapped('doc.extension', 'x', 'to_json(try_parse_json(x))')})"
    },
    derived={
        "parsed": f"from_json(measure, 'struct<extension:array<{INNER_EXTENSION}>>')",
        "inner": pairs(
            "parsed.extension",
            "x",
            "x.valueCodeableConcept.coding",
            "c",
            packed(
                tag=tail("x.url"),
                valueUrl="x.valueUrl",
                valueString="x.valueString",
                valueDecimal="x.valueDecimal",
                valueInteger="x.valueInteger",
                reference=tail("x.valueReference.reference"),
                span="concat(coalesce(x.valuePeriod.start, ''), ':', coalesce(x.valuePeriod.end, ''))",
                coding="c.code",
            ),
        ),
    },
    keys={"measure": "measure"},
    late_tops={
        "licensee_ref_record_id": by_measure("licensee", "e.reference"),
        "recognition_period": by_measure("recognitionPeriod", "e.span"),
        **{name: by_measure(tag, f"e.{carrier}") for carrier, tag, name in measure_columns()},
    },
)

BASIC_MEASURES = Resource(
    kind="Basic",
    schema=ddl(f"code:{CONCEPT}", f"identifier:{IDENTIFIER}", "extension:array<string>"),
    shape=_BASIC,
    # fixed values: the output columns in their order
    layout=(
        "file_export_type file_record_id version_id last_updtd_ts licensee_ref_record_id "
        "quality_recognition_type_cd quality_recognition_type_display recognition_type recognition_value "
        "recognition_entity recognition_webaddr recognition_period master_id master_id_type hospital_owner "
        "hospital_type emergency_service decile survey_response_rate_percent hcahps_answer_percent "
        "number_of_surveys hcahps_measure_cd star_rating linear_mean measure_cd "
        "hospital_survey_response_rate_footnote zscore process_measure_sample observed_rate_of_occurrences "
        "confidence_interval_value_low confidence_interval_value_high alt_rating at_risk_patients observed_cases "
        "expected_cases quintile_value messaging risk_adjusted_rate severity_index "
        "number_of_hospitals_at_alt_rating_benchmark state_low_cutpoint state_medium_cutpoint "
        "state_high_cutpoint state_very_high_cutpoint state_overall_cutpoint state_average "
        "state_average_bottom_20_percent state_average_top_20_percent national_low_cutpoint "
        "national_medium_cutpoint national_high_cutpoint national_very_high_cutpoint national_overall_cutpoint "
        "national_average national_average_bottom_20_percent national_average_top20_percent "
        "difference_in_observed_and_expected_rates achievement_points_numerator achievement_points_denominator "
        "improvement_points_numerator improvement_points_denominator condition_procedures_core "
        "measure_dim_score_numerator measure_dim_score_denominator weighted_performance_score "
        "unweighted_performance_score score_designation process_measure_score embold_mkt embold_specialty "
        "embold_status embold_tier embold_accnt profile_type load_dt"
    ).split(),
)

RESOURCES = {
    r.kind: r
    for r in (
        PRACTITIONER,
        PRACTITIONER_ROLE,
        LOCATION,
        ORGANIZATION,
        ORG_AFFILIATION,
        HEALTHCARE_SERVICE,
        INSURANCE_PLAN,
        BASIC_MEASURES,
    )
}
