"""Code lists, scores and ranges the rules are defined by.

They must keep these values for results to be right. Everything that may
differ between fleets is a parameter of the operators with one of these as
its default.
"""

# Vehicle types from least to most capable. The leading None stands for a
# vehicle whose type is unknown and ranks lowest.
TYPE_RANKING = [
    None,
    "AA002S",
    "AA002N",
    "AA004N",
    "WA002N",
    "SC002N",
    "SW002N",
    "SW004N",
    "SS001",
    "SS002",
    "SS004",
    "SS005",
    "SS012",
    "SC013",
    "SS014",
    "SC015",
    "SC113",
    "SC114",
    "DS004",
    "DS013",
    "DS014",
    "DS016",
]

# Score of the sixth letter of a type code: SUV, transport, ambulance (no
# letter), helicopter, aeroplane. Any other letter scores 0.
CLASS_SCORES = {"S": 1.0, "N": 2.0, "": 3.0, "H": 4.0, "A": 5.0}

# The scores of the first production run, where helicopters carried the
# aeroplane score and aeroplanes none.
CLASS_SCORES_FIRST_RUN = {"S": 1.0, "N": 2.0, "": 3.0, "H": 5.0}

# Score of the first four letters of a type code: stretcher kind and load.
STRETCHER_SCORES = {
    "SS00": 1.0,
    "SC00": 2.0,
    "DS00": 3.0,
    "SW00": 3.5,
    "SS01": 4.0,
    "SC01": 5.0,
    "DS01": 6.0,
    "SW01": 6.5,
    "SS10": 7.0,
    "SC10": 8.0,
    "DS10": 9.0,
    "SW10": 9.5,
    "SS11": 10.0,
    "SC11": 11.0,
    "DS11": 12.0,
    "SW11": 12.5,
}

WHEELCHAIR_PREFIXES = ["SW", "WA"]
AIR_LETTERS = ["H", "A"]

# Default type by numeric vehicle id. Both bounds are exclusive.
ID_RANGE_DEFAULTS = [
    ("UT_AA002N", [(4999, 9000), (19999, 40000)]),
    ("UT_SC002", [(999, 5000)]),
    ("UT_AA002S", [(39999, 50000), (9999, 19999)]),
    ("UT_GhostVehicle", [(899, 1000), (8999, 10000)]),
]

# Default type by dispatch kind, used when the id decides nothing.
KIND_DEFAULTS = [
    ("UT_AA002N", ["BNAT", "ENAT"]),
    ("UT_SC002", ["ALS", "BLS", "BLSr", "ALSr", "WING"]),
    (
        "UT_AA002S",
        ["DELTA", "COMP", "SUPER", "ECHO", "MIKE", "PRU", "FRU", "BPRU", "ITTEST", "EMR"],
    ),
    (
        "UT_GhostVehicle",
        ["DISP", "SEGWAY", "ATV", "FOOT", "BIKE", "CART", "TRAIN", "BUS", "MASS", "HOSP"],
    ),
    ("UT_SS002A.450", ["FLIGHT"]),
    ("UT_SS002H.250", ["HELI"]),
    ("UT_GhostVehicle", ["OTHER", "Other"]),
]
UNDEFINED_TYPE = "Undefined"

# Dispatch kinds.
GROUND_KINDS = ["ALS", "BLS", "PRU", "ENAT", "BNAT", "EMR", "WING", "ALSr"]
STUDY_GROUND_KINDS = ["ALS", "BLS", "ENAT", "BNAT", "EMR", "WING", "ALSr"]
AIR_KINDS = ["HELI", "FLIGHT"]
CREWED_KINDS = [
    "ALS", "BLS", "PRU", "ENAT", "BNAT", "EMR", "HELI", "WING", "FLIGHT", "ALSr",
    "COMP", "SUPER", "DELTA", "ECHO", "MIKE",
]
WEEKEND_UNITS = ["PICT-5A1", "PICT-5B1"]

# Agencies whose shifts are planned by system.
TRANSFER_AGENCIES = ["AHSETX", "AHSCTX", "AHSNTX", "AHSATX"]
MIXED_AGENCIES = ["AHSSCC", "AHSCCC", "AHSNCC"]
CITY_GROUPS = ["CALG", "EDMO"]
AIR_CREW = "Air Crew"

# Shift service labels.
CONTRACTED_SERVICES = [
    "Contracted - First Nation",
    "Contracted - Municipal/Not-for-Profit",
    "Contracted - First Nation (Private)",
    "Contracted - Integrated Fire",
    "Contracted - Private",
    "Contracted - Air",
]
DIRECT_SERVICE = "Direct Delivery"

# Test entries in the fleet register.
TEST_VEHICLES = ["Spare", "test123", "test(ALS)"]

# Words that mark an SUV in the fleet register, matched in any case.
SUV_MODELS = ["tahoe", "explorer", "yukon"]
SUV_CLASSES = ["suv"]
SUV_STOCK = ["pru", "admin", "community"]
SUV_DIVISION = "Community Care"
SUV_TYPE = "AA002S"

# Columns of the fleet register that describe a vehicle's set-up.
CONFIG_COLUMNS = [
    "vehicle_type",
    "stock_level",
    "stretcher_config",
    "stretcher_type",
    "pt_comp_size",
    "seating_config",
    "seating_config2",
]

# Vehicles whose type was checked by hand: (vehicle, type).
CHECKED_TYPES = [
    ("3089", "SC113"),
    ("3122", "SC113"),
    ("3148", "SC113"),
    ("3151", "SC113"),
    ("3158", "SC113"),
    ("3165", "SC113"),
    ("3182", "SC113"),
    ("3112", "DS013"),
]

# Contractor vehicles confirmed invalid.
INVALID_CONTRACT_VEHICLES = ["10095", "993", "114"]

# Unit letter to the type a planner would assume: (letter, type).
UNIT_KIND_DEFAULTS = [("A", "SC113"), ("B", "SC113"), ("T", "AA002N"), ("W", "SC113"), ("C", "SC113")]

# Unit letter to vehicle class.
CLASS_LETTERS = {"AMB": ["A", "B"], "NAT": ["T"], "SUV": ["P", "L", "S", "M", "D"]}

# Settings of the holdout sweep: (logons looked back on, share to exceed).
SWEEP_SETTINGS = [
    (14, 0.5), (28, 0.5), (7, 0.5), (1, 0.5),
    (14, 0.25), (28, 0.25), (7, 0.25),
    (14, 0.75), (28, 0.75), (7, 0.75),
]

# Survey form choices.
FORM_CHOICES = {
    "stretcher_config": ["Single", "Dual", "Other"],
    "stretcher_mount": ["Centre", "Side", "Other"],
    "stretcher_load": ["Manual", "Power", "Other"],
    "binary": ["Yes", "No"],
    "stock": ["ALS", "BLS", "Bariatric Level 2", "NICU", "PICU", "Other"],
}

# Survey form headings, in order.
AMBULANCE_FORM = [
    "EHS Number",
    "Last Logon Date",
    "Last Logon Unit",
    "Stock Level",
    "Stretcher Config",
    "Stretcher Mount Position",
    "Stretcher Load Type",
    "Stretcher Type",
    "Max Fixed Seats (incl driver)",
    "Max Folding Seats",
    "Bariatric Level 1 capable",
    "Fits Isolette",
    "Comments",
]
TRANSPORT_FORM = [
    "Vehicle Number",
    "Last Logon Date",
    "Last Logon Unit",
    "Max Stretchers",
    "Max Wheelchairs",
    "Max Ambulatory Patients",
    "Mixed Use",
    "Mixed Use Configurations",
    "Comments",
]

# Example rows printed at the top of each form.
AMBULANCE_EXAMPLES = [
    ("Example1", "2019-04-15", "CALG-1A1", "ALS", "Single", "Center", "Power", "Stryker Power-PRO XT", "5", "1", "Yes", "Yes", ""),
    ("Example2", "2019-04-15", "CALG-1B2", "BLS", "Dual", "Side", "Manual", "Ferno 35X", "3", "1", "No", "No", ""),
    ("Example3", "2019-04-15", "CALG-1A3", "Bariatric Level 2", "Single", "Center", "Manual", "Stryker MX-PRO Bariatric", "4", "1", "Yes", "No", ""),
    ("Example4", "2019-04-15", "CALG-1A4", "NICU", "Single", "Center", "Power", "Stryker Power-PRO IT", "4", "1", "No", "Yes", ""),
]
TRANSPORT_EXAMPLES = [
    ("Example1", "2019-04-15", "CALG-1T1", "2", "0", "0", "No", "", ""),
    (
        "Example2", "2019-04-15", "CALG-1T2", "1", "2", "4", "Yes",
        "1 wheelchair + 3 ambulatory / 1 stretcher + 1 ambulatory / 1 stretcher + 1 wheelchair", "",
    ),
]
