"""The fourteen tables of the dairy pipeline, as column mappings."""

from __future__ import annotations

from tierline.mapping import (dated_key, day, decimal2, identity_key, integer, phone, string,
                              table)

# Tables, columns, types, key formulas and quality rules below.
# Null defaults follow from the type (see NULL_DEFAULTS).
DIMENSIONS = [
    table("farmers_data", identity_key("farmer_id"),
          integer("farmer_id"), string("name", "farmer_name"),
          string("gender", rule="ColumnValues 'gender' in ['F','M']"),
          phone("phone"), integer("col_id"),
          integer("cattle_capacity", rule="ColumnValues 'cattle_capacity' >= 2"),
          integer("aadhar"), string("pan"), integer("bank_ac")),
    table("collection_center_data", identity_key("col_id"),
          integer("col_id"), integer("chl_id"), string("owner"), string("location"),
          phone("phone"), integer("aadhar"), string("pan"), integer("bank_ac")),
    table("chilling_center_data", identity_key("chl_id"),
          integer("chl_id"), string("owner", "owner_name"), string("location"),
          phone("phone"), string("aadhar"), string("pan"), integer("bank_ac")),
    table("logistics_contractor_data", identity_key("contractor_id"),
          integer("contractor_id"), string("owner"), string("vehicle_no"),
          phone("phone"), string("aadhar"), string("pan"), integer("bank_ac")),
    table("routes_data", identity_key("route_id", "string"),
          string("route_id"), string("stops"), integer("distance"), integer("cost")),
    table("distributor_data", identity_key("distributor_id"),
          integer("distributor_id"), string("name"), phone("phone"), string("area")),
    table("products_data", identity_key("product_id"),
          integer("product_id"), string("name"), integer("price"),
          string("sl", "shelf_life"), string("recipe_id")),
    table("recipe_data", identity_key("recipe_id", "string"),
          string("recipe_id"), string("raw_material"), integer("quantity_per_unit_ml")),
]

FACTS = [
    table("collection_center_procurement", dated_key("farmer_id"),
          integer("farmer_id"), day("date"), integer("quantity"), decimal2("fat"),
          decimal2("snf"), decimal2("amount"), integer("col_id")),
    table("chilling_center_procurement", dated_key("col_id"),
          integer("col_id"), integer("quantity"), decimal2("fat"), decimal2("snf"),
          day("date"), string("qa_check"), decimal2("commission"), string("route_id"),
          integer("chl_id")),
    table("aggregated_procurement", dated_key("chl_id"),
          integer("chl_id"), integer("quantity"), decimal2("fat"), decimal2("snf"),
          day("date"), string("qa_check"), string("route_id")),
    table("daily_logistics", dated_key("route_id", cast_to="string"),
          string("route_id"), integer("contractor_id"), string("material"), day("date")),
    table("production_data", dated_key("product_id"),
          string("batch_no"), day("date"), integer("product_id"), integer("quantity")),
    table("sales_data", dated_key("product_id", "distributor_id", cast_to="string"),
          string("sales_id"), day("date"), integer("product_id"), integer("quantity"),
          integer("distributor_id"), string("route_id")),
]

DIMENSION_TABLES = tuple(t.name for t in DIMENSIONS)
FACT_TABLES = tuple(t.name for t in FACTS)
MAPPING = {t.name: t for t in sorted(DIMENSIONS + FACTS, key=lambda t: t.name)}
# Catalog databases.
SILVER_DATABASE, GOLD_DATABASE = "pf_silver_db", "pf_gold_db"
