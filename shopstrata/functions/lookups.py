"""Lookup tables of the retail domain.

Fixed values: every code, name and region below is part of the expected results.
"""

CATEGORY_CODES = {
    "GROCERY": "GRCY",
    "BOOKS": "BKS",
    "TOYS": "TOY",
}

BRAND_CODES = {
    "stcr": "SteelCraft",
    "hmns": "HomeNest",
    "aqpr": "AquaPure",
    "csnv": "CasaNova",
    "prlv": "PureLiving",
    "ckmt": "CookMate",
    "wrmh": "WarmHearth",
    "acme": "AcmeTech",
    "phtx": "Photonix",
    "ecot": "EcoTone",
    "bytm": "ByteMax",
    "novw": "NovaWave",
    "urtl": "UrbanTrail",
    "ggrn": "GoodGrain",
    "slke": "SilkEssence",
    "volt": "VoltEdge",
    "cblt": "CobaltWear",
    "arft": "AeroFit",
    "mosa": "Mosaic",
    "rkbr": "RocketBear",
    "gmfg": "GameForge",
    "grbk": "GreenBasket",
    "dmlx": "DermaLux",
    "znth": "Zenith",
    "btnq": "Botaniq",
    "skyl": "SkyLink",
    "ablf": "AmberLeaf",
    "hrbc": "HerbaCare",
    "plcb": "PlayCube",
    "ftfx": "FitFlex",
    "cotc": "CottonClub",
    "nthr": "NorthThread",
    "dlhv": "DailyHarvest",
    "frfl": "FreshFields",
    "frmj": "FarmJoy",
    "ntch": "NutriChoice",
    "glow": "GlowOn",
    "alms": "AloeMist",
    "trbz": "TrailBlazer",
    "prsd": "ProStride",
    "pkpr": "PeakPro",
    "swcr": "SwiftCore",
    "smln": "SummitLine",
    "kdln": "KiddoLand",
    "tngr": "TinyGears",
    "hpfn": "HappyFun",
    "pgtr": "PageTurner",
    "qlhs": "QuillHouse",
    "stac": "StoryArc",
    "lfsp": "LeafSpine",
    "blin": "BlueInk",
    "rdmr": "ReadMore",
}

REGIONS = {
    "India": {
        "MH": "West", "GJ": "West", "RJ": "West",
        "KA": "South", "TN": "South", "TS": "South", "AP": "South", "KL": "South",
        "UP": "North", "WB": "North", "DL": "North",
    },
    "Australia": {"VIC": "SouthEast", "WA": "West", "NSW": "East", "QLD": "NorthEast"},
    "United Kingdom": {
        "ENG": "England", "WLS": "Wales", "NIR": "Northern Ireland", "SCT": "Scotland",
    },
    "United States": {
        "MA": "NorthEast", "FL": "South", "NJ": "NorthEast",
        "CA": "West", "NY": "NorthEast", "TX": "South",
    },
    "United Arab Emirates": {"AUH": "Abu Dhabi", "DU": "Dubai", "SHJ": "Sharjah"},
    "Singapore": {"SG": "Singapore"},
    "Canada": {
        "BC": "West", "AB": "West", "ON": "East", "QC": "East", "NS": "East", "IL": "Other",
    },
}

# Codes examined one by one in the product quality report.
REPORTED_CATEGORIES = ("hnk", "ce", "app", "grcy", "bpc", "spt", "toy", "bks")

DOMESTIC_CARRIERS = ("ECOMEXPRESS", "DELHIVERY", "XPRESSBEES", "BLUEDART")

CHANNEL_NAMES = {"web": "Website", "app": "Mobile"}

RETURN_POLICY_DAYS = 15
SUMMARY_WINDOW_DAYS = 30
MISSING = "Not Available"
OTHER_REGION = "Other"
