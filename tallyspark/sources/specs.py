"""Column specs of the datasets and their dimension keys.

A spec lists the raw columns that are kept, in output order, with target name and type; a raw column after a dash is
typed in raw reads and dropped from conformed ones. Raw columns that no line names are text, and dropped too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw column = name type.
DAC1 = """
DONOR = donor_code string
Donor = donor_name string
MEASURE = aidtype_code int
Measure = aid_type string
FLOW_TYPE = flows_code int
Flow type = fund_flows string
UNIT_MEASURE = unit_measure_code string
Unit of measure = unit_measure_name string
PRICE_BASE = amounttype_code string
Price base = amount_type string
SECTOR = sector_code string
Sector = sector_name string
TIME_PERIOD = year int
OBS_VALUE = value double
BASE_PER = base_period int
UNIT_MULT = unit_multiplier int
-Time period = time_period int
-Observation value = observation_value double
-Base period = base_period_name int
-DECIMALS = decimals int
"""

# Raw column = name type.
DAC2A = """
DONOR = donor_code string
Donor = donor_name string
RECIPIENT = recipient_code string
Recipient = recipient_name string
MEASURE = aidtype_code int
Measure = aid_type string
FLOW_TYPE = flow_type_code string
Flow type = flow_type_name string
UNIT_MEASURE = unit_measure_code string
Unit of measure = unit_measure_name string
PRICE_BASE = data_type_code string
Price base = amount_type string
TIME_PERIOD = year int
OBS_VALUE = value double
BASE_PER = base_period int
UNIT_MULT = unit_multiplier int
-Time period = time_period int
-Observation value = observation_value double
-Base period = base_period_name int
-DECIMALS = decimals int
"""

# Raw column = name type.
MULTISYSTEM = """
DONOR = donor_code string
Donor = donor_name string
RECIPIENT = recipient_code string
Recipient = recipient_name string
SECTOR = sector_code int
Sector = sector_name string
MEASURE = aidtype_code int
Measure = aid_type string
CHANNEL = channel_code int
Channel = channel_name string
FLOW_TYPE = flow_type_code string
Flow type = flow_type_name string
PRICE_BASE = data_type_code string
Price base = amount_type string
Drilldown dimension = dimension_name string
UNIT_MEASURE = unit_measure_code string
Unit of measure = unit_measure_name string
TIME_PERIOD = year int
OBS_VALUE = value double
BASE_PER = base_period int
UNIT_MULT = unit_multiplier int
-MD_ID = md_id smallint
-Microdata ID = microdata_id smallint
-Time period = time_period int
-Observation value = observation_value double
-Base period = base_period_name int
-DECIMALS = decimals int
"""

# Raw column = name type.
CRS = """
DONOR = donor_code string
Donor = donor_name string
RECIPIENT = recipient_code string
Recipient = recipient_name string
SECTOR = sector_code int
Sector = sector_name string
MEASURE = measure_code int
Measure = measure_name string
CHANNEL = channel_code int
Channel = channel_name string
MODALITY = flow_code string
Modality = flow_name string
FLOW_TYPE = flow_type_code string
Flow type = flow_type_name string
PRICE_BASE = data_type_code string
Price base = amount_type string
Drilldown dimension = md_dim_name string
MD_ID = md_id bigint
UNIT_MEASURE = unit_measure_code string
Unit of measure = unit_measure_name string
TIME_PERIOD = year int
OBS_VALUE = value double
BASE_PER = base_period int
Observation status = status_name string
UNIT_MULT = unit_multiplier int
DONOR_AGENCY = donor_agency_code string
Donor agency = donor_agency_name string
OECD_ID = crs_id string
DONOR_PROJECT_ID = project_id string
REGION = region_code string
Region = region_name string
INCOME_GROUP = income_group_code string
Income group = income_group_name string
CHANNEL_DELIVERY_CODE = channel_delivery_code int
CHANNELDELIVERY_CODE = channel_delivery_code int
CHANNELDELIVERY_NAME = channel_delivery_name string
CATEGORY_CODE = category_code int
CATEGORY_NAME = category_name string
FINANCETYPE_CODE = finance_type_code int
FINANCETYPE_NAME = finance_type_name string
BIMULTI_CODE = bi_multi_code int
SHORT_DESCRIPTION = short_description string
PROJECT_TITLE = project_title string
LONG_DESCRIPTION = long_description string
SDG_FOCUS = sdg_focus string
GENDER_EQUALITY = gender_equality int
ENVIRONMENT = environment int
GOVERNANCE = governance int
RMNCH = rmnch int
DRR = drr int
NUTRITION = nutrition int
DISABILITY = disability int
BIODIVERSITY = biodiversity int
CLIMATE_MITIGATION = climate_mitigation int
CLIMATE_ADAPTATION = climate_adaptation int
DESERTIFICATION = desertification int
AMOUNT_TIED = amount_tied double
AMOUNT_UNTIED = amount_untied double
AMOUNT_PARTLY_UNTIED = amount_partly_untied double
NATURE_OF_SUBMISSION = nature_of_submission int
-Time period = time_period int
-Observation value = observation_value double
-Base period = base_period_name int
-DECIMALS = decimals int
-Amount tied = amount_tied_value double
-Amount untied = amount_untied_value double
-Amount partly untied = amount_partly_untied_value double
"""

# Raw column = name type. A leading ? marks yes/no flags, a leading - dropped columns.
AIDDATA = """
AidData Record ID = aiddata_id string
?Recommended For Aggregates = recommended_for_aggregates string
AidData Parent ID = aiddata_parent_id string
?Umbrella = umbrella string
Financier Country = donor_name string
Recipient = recipient_name string
Recipient ISO-3 = recipient_iso3 string
Recipient Region = region_name string
Commitment Year = commitment_year int
Implementation Start Year = start_year int
Completion Year = completion_year int
Title = project_title string
Description = long_description string
Staff Comments = staff_comments string
Status = project_status string
Intent = project_intent string
Flow Type = flow_type string
Flow Type Simplified = flow_type_simplified string
OECD ODA Concessionality Threshold = oda_concessionality_threshold double
Flow Class = flow_class string
Sector Code = sector_code int
Sector Name = sector_name string
?Infrastructure = infrastructure string
?COVID = covid string
Funding Agencies = donor_agencies_name string
Funding Agencies Type = donor_agencies_type string
?Co-financed = co_financed string
Co-financing Agencies = co_financing_agencies_name string
Co-financing Agencies Type = co_financing_agencies_type string
Direct Receiving Agencies = direct_recipient_agencies_name string
Direct Receiving Agencies Type = direct_recipient_agencies_type string
Indirect Receiving Agencies = indirect_recipient_agencies_name string
Indirect Receiving Agencies Type = indirect_recipient_agencies_type string
?On-lending = on_lending string
Implementing Agencies = implementing_agencies_name string
Implementing Agencies Type = implementing_agencies_type string
?Guarantee Provided = guarantee_provided string
Guarantor = guarantor_name string
Guarantor Agency Type = guarantor_type string
?Insurance Provided = insurance_provided string
Insurance Provider = insurance_provider_name string
Insurance Provider Agency Type = insurance_provider_type string
?Collateralized = collateralized string
Collateral Provider = collateral_provider_name string
Collateral Provider Agency Type = collateral_provider_type string
Security Agent/Collateral Agent = collateral_agent_name string
Security Agent/Collateral Agent Type = collateral_agent_type string
Collateral = collateral string
Amount (Original Currency) = commitment_original_currency double
Original Currency = original_currency string
?Amount Estimated = amount_estimated string
Amount (Constant USD 2021) = usd_commitment_constant double
Amount (Nominal USD) = usd_commitment double
Adjusted Amount (Original Currency) = adjustment_original_currency double
Adjusted Amount (Constant USD 2021) = usd_adjustment_constant double
Adjusted Amount (Nominal USD) = usd_adjustment double
?Financial Distress = financial_distress string
Commitment Date (MM/DD/YYYY) = commitment_date date
?Commitment Date Estimated = commitment_date_estimated string
Planned Implementation Start Date (MM/DD/YYYY) = expected_start_date date
Actual Implementation Start Date (MM/DD/YYYY) = actual_start_date date
?Actual Implementation Start Date Estimated = actual_start_date_estimated string
Deviation from Planned Implementation Start Date = deviation_expected_actual_start_date int
Planned Completion Date (MM/DD/YYYY) = expected_completion_date date
Actual Completion Date (MM/DD/YYYY) = actual_completion_date date
?Actual Completion Date Estimated = actual_completion_date_estimated string
Deviation from Planned Completion Date = deviation_expected_actual_completion_date int
Maturity = maturity double
Interest Rate = interest_rate double
Grace Period = grace_period double
Management Fee = management_fee double
Commitment Fee = commitment_fee double
Insurance Fee (Percent) = insurance_fee_percent double
Insurance Fee (Nominal USD) = insurance_fee_usd double
Default Interest Rate = default_interest_rate double
First Loan Repayment Date = repaydate1 date
Last Loan Repayment Date = repaydate2 date
Grant Element (OECD Cash-Flow) = grant_element_flow double
Grant Element (OECD Grant-Equiv) = grant_element_grant_equiv double
Grant Element (IMF) = grant_element_imf double
Number of Lenders = number_of_lenders string
?Export Buyer's Credit = export_buyers_credit string
?Supplier’s Credit/Export Seller’s Credit = suppliers_credit_export_sellers_credit string
?Interest-Free Loan = interest_free_loan string
?Refinancing = refinancing string
?Investment Project Loan = investment_project_loan string
?M&A = ma string
?Working Capital = working_capital string
?EPCF = epcf string
?Lease = lease string
?FXSL/BOP = fxsl_bop string
?CC IRS = cc_irs string
?RCF = rcf string
?GCL = gcl string
?PBC = pbc string
?PxF/Commodity Prepayment = pxf_commodity_prepayment string
?Inter-Bank Loan = inter_bank_loan string
?Overseas Project Contracting Loan = overseas_project_contracting_loan string
?DPA = dpa string
?Project Finance = project_finance string
?Involving Multilateral = involving_multilateral string
?Non-Chinese Financier = non_chinese_financier string
?Short-Term = short_term string
?Rescue = rescue string
Project JV/SPV Host Government Ownership = project_jv_spv_host_government_ownership string
Project JV/SPV Chinese Government Ownership = project_jv_spv_chinese_government_ownership string
Level of Public Liability = level_of_public_liability string
-Total Source Count = total_source_count int
-Official Source Count = official_source_count int
-Source URLs = source_urls string
-Source Titles = source_titles string
-Source Publishers = source_publishers string
-Source Resource Types = source_resource_types string
-Contact Name = contact_name string
-Contact Position = contact_position string
?ODA Eligible Recipient = oda_eligible_recipient string
OECD ODA Income Group = income_group_name string
Location Narrative = location_narrative string
Geographic Level of Precision Available = geographic_precision_level string
?ADM1 Level Available = adm1_level_available string
?ADM2 Level Available = adm2_level_available string
?Geospatial Feature Available = geospatial_feature_available string
Source Quality Score = source_quality int
Data Completeness Score = data_completeness int
Implementation Detail Score = implementation_detail int
Loan Detail Score = loan_detail int
"""


@dataclass(frozen=True)
class Field:
    raw: str
    name: str
    type: str
    flag: bool = False
    keep: bool = True


def _parse(text: str) -> tuple[Field, ...]:
    fields = []
    for line in text.strip().splitlines():
        raw, target = line.rsplit(" = ", 1)
        name, kind = target.split()
        fields.append(Field(raw.lstrip("-?"), name, kind, "?" in raw[:2], not raw.startswith("-")))
    return tuple(fields)


SPECS = {"dac1": _parse(DAC1), "dac2a": _parse(DAC2A), "multisystem": _parse(MULTISYSTEM), "crs": _parse(CRS), "cpa": _parse(CRS), "aiddata": _parse(AIDDATA)}

#: Columns that aggregate rows may fill with text, so that a failed typed read makes the whole column text.
FALLBACK = ("CHANNEL", "MODALITY", "MD_DIM")

# The position of each dimension in a series key.
_PROJECT = "donor recipient sector measure channel modality flow_type price_base md_dim md_id unit_measure".split()
DIMENSIONS = {
    "dac1": "donor sector measure tying_status flow_type unit_measure price_base".split(),
    "dac2a": "donor recipient measure unit_measure price_base".split(),
    "multisystem": "donor recipient sector measure channel flow_type price_base md_dim md_id unit_measure".split(),
    "crs": _PROJECT,
    "cpa": _PROJECT,
}
#: Positions that no filter argument sets.
INTERNAL = {"tying_status", "md_dim", "md_id"}
#: Dimensions that hold totals beside details, to pin when aggregates are asked for.
TOTALLED = {"crs": ("channel", "modality"), "cpa": ("channel", "modality"), "multisystem": ("recipient", "sector")}


_TYPES = {"string": T.StringType(), "tinyint": T.ByteType(), "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}


def spec_of(dataset: str) -> tuple[Field, ...]:
    if dataset not in SPECS:
        raise ValueError(f"unknown dataset {dataset!r}; known: {', '.join(SPECS)}")
    return SPECS[dataset]


def raw_column(dimension: str) -> str:
    return dimension.upper()


def struct_of(dataset: str) -> T.StructType:
    """The schema of a conformed table."""
    merged: dict[str, str] = {}
    for f in spec_of(dataset):
        if f.keep:
            merged.setdefault(f.name, "tinyint" if f.flag else f.type)
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in merged.items()])
