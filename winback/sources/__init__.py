from winback.sources.parquet_tables import load_tables, load_warehouse, save_tables, warehouse_orders
from winback.sources.schemas import ShopTables
from winback.sources.shop_csv import csv_rejects, delivered, load_and_clean_data
from winback.sources.sinks import write_leads

__all__ = [
    "ShopTables",
    "csv_rejects",
    "delivered",
    "load_and_clean_data",
    "load_tables",
    "load_warehouse",
    "save_tables",
    "warehouse_orders",
    "write_leads",
]
