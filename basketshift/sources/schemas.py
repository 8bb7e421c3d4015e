"""Input and result schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


ORDER_LINES = ("user_id string, parent_sale_ord_id string, item_sku_id string, sale_ord_id string, "
               "sale_ord_tm timestamp_ntz, sale_qtty double, after_prefr_amount decimal(18,4), "
               "before_prefr_amount decimal(18,2)")
SKU_MASTER = ("item_sku_id string, sku_name string, sku_status_cd string, wt string, spu_id string, "
              "item_third_cate_cd string, dt string, pop_vender_id string, sku_type string")
ATTRIBUTES = "sku_id string, web_id int, attr_name string, attr_value string"
EXTENDED_ATTRIBUTES = ("data_type int, item_sku_id string, com_attr_name string, com_attr_value_name string, "
                       "cate_id string, dt string")
BRAND_DICT = "brand_id string, brand_name string"
COMPETITOR_PRICES = "item_sku_id string, avg_price double, status int, dt string"
CATEGORY_TREE = ("item_first_cate_cd string, item_second_cate_cd string, item_third_cate_cd string, "
                 "item_third_cate_name string")
FOURTH_CATEGORY = "sku_id string, attr_value string"
IGNORED_ATTRIBUTES = "scope_id string, ignored_attr string"
CLICK_LOG = ("item_sku_id string, user_log_acct string, request_tm timestamp_ntz, session_id string, bs string, "
             "dt date")
CONTROL = "status string, dt string, cid3 string"

# Results.
SWITCHING = "scope_id string, src_item_id string, dst_item_id string, switching_prob double, model string"
SKU_IN_SCOPE = "scope_id string, item_sku_id string, item_id string, item_name string, item_type string"
CDT = "scope_id string, attdesc string, Estimate double, SimulationType string"
STATUS = ("scope_id string, input_check string, sku_number string, switch_check string, cdt_check string, "
          "status string")
SCOPE = ("id string, item_first_cate_cd string, item_second_cate_cd string, item_third_cate_cd string, "
         "self_pop string, scope_type string, scope_desc string, item_type string")


def struct(spec: str) -> T.StructType:
    return _struct(spec)


def conform(df: DataFrame, spec: str) -> DataFrame:
    """Select the columns of ``spec`` with its types; a missing column fails here."""
    want = _struct(spec)
    missing = [f.name for f in want if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in want])
