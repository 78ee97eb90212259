"""Codes and lists that the source tables and the mart define.

They are data, stated as they occur in the tables, and must not be changed.
"""

# Source tags of the control table, in the order of the pending view's columns.
SOURCE_TAGS = ("EU_AS400", "EU_ATLAS", "EU_HYBR_EOM", "EU_HYBR_NON_EOM")

# Earliest order month that a change may re-open.
REOPEN_FLOOR = 202102

# Months always rebuilt, months rebuilt by a day run, and the hours of the runs that clear
# the whole backlog.
ALWAYS_MONTHS = 2
DAY_RUN_MONTHS = 3
NIGHT_HOURS = (22, 23)

# Affiliates by source system. The moving ones leave source 1 after LAST_MONTH_OLD
# and enter source 4 in FIRST_MONTH_NEW.
SRC1_AFFILIATES = ("040",)
SRC2_AFFILIATES = ("570",)
SRC3_AFFILIATES = ("030",)
SRC4_AFFILIATES = ("160", "090", "470", "250", "430", "420", "060", "110", "210")
MOVING_AFFILIATES = ("150", "480")
LAST_MONTH_OLD = 202108
FIRST_MONTH_NEW = 202109

# Countries whose consignments source 4 reads, and those it reads from FIRST_MONTH_NEW.
SRC4_CONSIGNMENT_COUNTRIES = (
    "210", "080", "060", "160", "120", "090", "470", "460",
    "280", "370", "270", "250", "110", "430", "830", "420",
)
SRC4_MOVING_CONSIGNMENT_COUNTRIES = (
    "620", "650", "390", "800", "340", "820", "810",
    "150", "590", "490", "140", "450", "660", "480",
)

# Placeholder volume accounts in source 4: country -> account number.
PLACEHOLDER_ACCOUNTS = {
    "160": "3000001", "060": "8", "210": "3", "080": "3", "110": "3", "480": "5",
}
# Countries whose placeholder account number is the country code itself.
PLACEHOLDER_IS_COUNTRY = (
    "620", "650", "390", "800", "340", "820", "810", "150", "590", "490", "140", "450",
)
# Billing types of source 4 that count as business owners.
OWNER_BILLING_TYPES = (
    "SOCIO CONSUMIDOR", "I", "ABO SE", "ABO", "AMWAY DIRECT RETAILER", "VIP Customer",
)
# The country whose point value is the line total.
TOTAL_POINTS_COUNTRY = "430"

# Ship-to country code -> country number.
SRC2_SHIP_COUNTRIES = {"ZA": 570, "NA": 740, "BW": 750}
SRC2_SHIP_DEFAULT = 570
SRC3_SHIP_COUNTRIES = {
    "MY": 100, "PH": 350, "SG": 530, "BN": 780, "VN": 500, "AU": 30, "NZ": 240,
}
SRC3_FULFILMENT_COUNTRIES = ("AU", "NZ")

# Price list of a source 3 order -> account type.
PRICE_LIST_TYPES = {
    "AmwayDefaultRetailPriceGroup": "Customer",
    "AmwayDefaultEmployeePriceGroup": "Employee",
    "AmwayDefaultABOPriceGroup": "ABO",
}
OWNER_PRICE_LIST = "AmwayDefaultABOPriceGroup"

# Fee codes that are rounding differences, not delivery fees.
ROUNDING_FEES = ("netRoundOff_increase", "netRoundOff_decrease")

# Source 2: prefix of account numbers, clock of the source and clock of the mart.
SRC2_ACCOUNT_PREFIX = "570"
SRC2_COMBINED_TYPE = "ZA_COMBINED_ORDER"
SRC2_ZONE = "America/Detroit"
MART_ZONE_SRC2 = "Africa/Johannesburg"

# Order nature of an invoice -> account type, and natures billed to the ordering account.
NATURE_TYPES = {1: "ABO", 3: "Member", 6: "Employee"}
ORDERING_NATURES = (3, 6)

# Invoice transactions that are order invoices.
INVOICE_AFFILIATES = (570, 30)
INVOICE_TRX_SOURCE = "003"

# Country keys of the history load.
HISTORY_COUNTRY_KEYS = (
    5, 26, 23, 134, 56, 39, 76, 34, 74, 75, 17, 54, 48, 16, 44, 57, 10, 8, 47, 18, 14, 11,
    46, 45, 30, 37, 29, 27, 13, 32, 6, 42, 114, 41,
)
# First and last month of the history load, as year * 12 + month.
HISTORY_MONTHS = (24093, 24242)

# Country number -> partition group; every other country goes to OTHER_GROUP.
COUNTRY_GROUPS = {
    "AFF_10": (10, 20, 580, 700),
    "AFF_30": (30, 240),
    "AFF_40": (40, 300),
    "AFF_60": (60, 80),
    "AFF_70": (70,),
    "AFF_90": (90, 120),
    "AFF_100": (100, 530, 780),
    "AFF_110": (110,),
    "AFF_130": (130,),
    "AFF_150": (140, 150, 340, 390, 450, 490, 590, 620, 650, 660, 800, 810, 820),
    "AFF_160": (160,),
    "AFF_170": (170, 190, 230, 260, 290, 310, 380, 400, 440, 510, 520, 600),
    "AFF_180": (180,),
    "AFF_200": (200,),
    "AFF_210": (210,),
    "AFF_220": (220,),
    "AFF_250": (250, 270),
    "AFF_350": (350,),
    "AFF_360": (50, 360),
    "AFF_420": (420, 830),
    "AFF_430": (430,),
    "AFF_470": (280, 370, 460, 470),
    "AFF_480": (480,),
    "AFF_570": (570, 740, 750),
    "AFF_500": (500,),
}
OTHER_GROUP = "OTHR"
