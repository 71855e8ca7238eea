"""Business parameters: values that change by season or by customer.

They are data, passed as arguments everywhere; these are the defaults.
"""

from __future__ import annotations

# fixed values: season windows
ORDER_SEASONS = ("SP-20", "FA-20")
HEADER_CARTON_SEASONS = ("FA-20", "SP-20")
CONTAINER_CARTON_SEASONS = ("FA-19", "SP-20")

# fixed values: divisions and customers with their own treatment
EXCLUDED_DIV = 8
VARIOUS_CUSTOMER = "87700"
GREEN_BAR_CUSTOMERS = ("87376",)
OFFPRICE_EXEMPT_CUSTOMERS = ("42071", "42070", "78190")

# fixed values: customer -> length of the purchase-order number proper
PO_PREFIX_LENGTHS = {"61050": 7}

# fixed values: customer names that stand for another customer
CUSTOMER_ALIASES = {"SHOPKO (OLD)": "SHOPKO", "JCP.COM": "JCP"}

# fixed values: an unshipped line this close to its cancel date counts as due
DUE_WITHIN_DAYS = 5

# fixed values: money differences from here on are reported
MONEY_TOLERANCE = "0.01"

# fixed values: manual fixes, applied in this order after the load
ASSOC_CORRECTIONS = (
    ({"GREEN_BAR": "878294", "STYLE": "138196", "COLOR": "503"}, {"HFC": "197218"}),
    ({"GREEN_BAR": "876766"}, {"CXL": 0}),
)
OFFPRICE_CORRECTIONS = (
    ({"CUST_PO": "114350"}, {"COMMENT_2": "UPFRONT"}),
    ({"CUST_PO": "1037316"}, {"COMMENT_2": "UPFRONT"}),
)

# fixed values: scale codes with a meaning of their own
BULK_SCALE = "00"
MIXED_SCALE = "Z9"
