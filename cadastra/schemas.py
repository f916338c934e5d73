"""Column lists of the raw and derived tables."""

from __future__ import annotations

from pyspark.sql.types import DataType, StructType

EVENT = "source_id string, effective_date date"

LAND_VALUE_COLUMNS = [
    "DISTRICT CODE", "DISTRICT NAME", "PROPERTY ID", "PROPERTY TYPE", "PROPERTY NAME", "UNIT NUMBER",
    "HOUSE NUMBER", "STREET NAME", "SUBURB NAME", "POSTCODE", "PROPERTY DESCRIPTION", "ZONE CODE",
    "AREA", "AREA TYPE",
] + [
    f"{name} {i}" for i in range(1, 6) for name in ("BASE DATE", "LAND VALUE", "AUTHORITY", "BASIS")
]

TABLES = {
    "land_value_row": "district_code int, district_name string, property_id int, property_type string,"
    " property_name string, unit_number string, house_number string, street_name string, suburb_name string,"
    " postcode string, property_description string, zone_code string, zone_standard string, area double,"
    " area_type string, "
    + ", ".join(
        f"base_date_{i} date, land_value_{i} bigint, authority_{i} string, basis_{i} string" for i in range(1, 6)
    )
    + ", source_file_name string, source_line_number int, source_date date",
    "ps_row_a_legacy": "position bigint, file_path string, year_of_sale int, submitting_user_id string,"
    " date_provided timestamp",
    "ps_row_b_legacy": "position bigint, file_path string, district_code int, source string,"
    " valuation_number string, property_id int, unit_number string, house_number string, street_name string,"
    " locality_name string, postcode string, contract_date date, purchase_price double,"
    " land_description string, area double, area_type string, dimensions string, comp_code string,"
    " zone_code string, zone_standard string",
    "ps_row_a": "position bigint, file_path string, year_of_sale int, file_type string, district_code int,"
    " date_provided timestamp, submitting_user_id string",
    "ps_row_b": "position bigint, file_path string, district_code int, property_id int, sale_counter int,"
    " date_provided timestamp, property_name string, unit_number string, house_number string,"
    " street_name string, locality_name string, postcode string, area double, area_type string,"
    " contract_date date, settlement_date date, purchase_price double, zone_code string,"
    " zone_standard string, nature_of_property string, primary_purpose string, strata_lot_number int,"
    " comp_code string, sale_code string, interest_of_sale int, dealing_number string",
    "ps_row_c": "position bigint, file_path string, district_code int, property_id int, sale_counter int,"
    " date_provided timestamp, property_description string",
    "ps_row_d": "position bigint, file_path string, district_code int, property_id int, sale_counter int,"
    " date_provided timestamp, participant string",
    "ps_row_z": "position bigint, file_path string, total_records int, total_sale_property_details int,"
    " total_sale_property_legal_descriptions int, total_sale_participants int",
    "legal_description": EVENT + ", legal_description_id string, property_id int, strata_lot_number int,"
    " legal_description string, legal_description_kind string",
    "lot_feature_layer": "object_id bigint, lot_id_string string, last_update timestamp, shape_area double,"
    " geometry array<array<struct<x:double,y:double>>>",
    "property_feature_layer": "rid bigint, property_id int, principal_address_type int,"
    " address_string_oid int, last_update timestamp, shape_area double,"
    " geometry array<array<struct<x:double,y:double>>>",
}


def table_schema(name: str) -> StructType:
    return DataType.fromDDL(TABLES[name])
