"""Small test inputs as literals.  Everything here is a fixed value that must equal the original: the CSV texts and the cost
file, their checksums, the check configuration and the expected rows and verdicts."""

# --- fixed values: forest-fire sample files (good, corrupt, invalid) and the cost file ---
FIRES_GOOD = """1,2,aug,fri,91,166.9,752.6,7.1,25.9,41,3.6,0,100
2,2,feb,mon,84,9.3,34,2.1,13.9,40,5.4,0,57.8
3,4,mar,sat,69,2.4,15.5,0.7,17.4,24,5.4,0,92.9
4,4,mar,mon,87.2,23.9,64.7,4.1,11.8,35,1.8,0,1300
5,5,mar,sat,91.7,35.8,80.8,7.8,15.1,27,5.4,0,4857
6,5,sep,wed,92.9,133.3,699.6,9.2,26.4,21,4.5,0,9800
7,5,mar,fri,86.2,26.2,94.3,5.1,8.2,51,6.7,0,14
8,6,mar,fri,91.7,33.3,77.5,9,8.3,97,4,0.2,74.5
9,9,feb,thu,84.2,6.8,26.6,7.7,6.7,79,3.1,0,8880.7
"""

FIRES_CORRUPT = """one,2,aug,fri,91,166.9,752.6,7.1,25.9,41,3.6,0,0
two,2,feb,mon,84,9.3,34,2.1,13.9,40,5.4,0,0
three,4,mar,satoorday,69,2.4,15.5,0.7,17.4,24,5.4,0,0
four,4,mar,mon,87.2,23.9,64.7,4.1,11.8,35,1.8,0,0
five,5,mar,sat,91.7,35.8,80.8,7.8,15.1,27,5.4,0,0
six,5,sep,wed,92.9,133.3,abcd,9.2,26.4,21,4.5,0,0
seven,5,mar,fri,86.2,26.2,94.3,5.1,8.2,51,6.7,0,0
eight,6,mar,fri,91.7,33.3,77.5,9,8.3,97,4,0.2,0
nine,9,fb,thu,84.2,6.8,26.6,7.7,6.7,79,3.1,0,0
"""

FIRES_INVALID = """1,2,ag,fri,91,166.9,752.6,7.1,25.9,41,3.6,0,0
2,2,feb,mon,84,9001,34,2.1,13.9,40,5.4,0,0
3,4,mar,satoorday,69,2.4,15.5,0.7,17.4,24,5.4,0,0
4,4,mar,mon,87.2,23.9,64.7,4.1,11.8,35,1.8,0,0
5,5,mar,sat,91.7,35.8,80.8,7.8,15.1,27,5.4,0,0
6,5,sep,wed,92.9,133.3,5,9.2,26.4,21,4.5,0,0
7,5,mar,fri,86.2,26.2,94.3,5.1,8.2,51,6.7,0,0
8,6,mar,fri,91.7,33.3,77.5,9,8.3,97,4,0.2,0
9,9,fb,thu,84.2,6.8,26.6,7.7,6.7,79,3.1,0,0
"""

COSTS = """1,150000,32000,10000
2,200000,50000,50000
3,90000,120000,300000
4,230000,14000,7000
5,98000,27000,48000
6,72000,800000,0
7,50000,2500000,0
8,8000000,33000000,0
9,6325000,450000,76000
"""

FIRE_SCHEMA = ("id int, y int, month string, day string, ffmc double, dmc double, dc double, isi double, "
               "temp double, rh double, wind double, rain double, area double")
COST_SCHEMA = "id int, land_damage_cost int, property_damage_cost int, lost_profits_cost int"

# File checksums of the three fire files.
FIRE_MD5 = {
    "good": "dec0da571ca6a4462ddc87fc88c1efee",
    "corrupt": "fb7b1751c3354508cbef67a5ca7c38f8",
    "invalid": "ba6ca9f87c2478f40ba1558f68d596f8",
}

# Check configuration of the fire pipeline.
TABLE_CHECKS = [
    {"row_count_check": {"check_statement": "COUNT(*) = 9"}},
    {"dmc_less_than_twice_dc_check": {"check_statement": "2 * dmc < dc"}},
]
COL_CHECKS = [
    {"id": {"null_check": {"equal_to": 0}, "distinct_check": {"equal_to": 9}}},
    {"ffmc": {"min": {"geq_to": 50}, "max": {"less_than": 100}}},
]

# Ground truth rows: all values are text.
GROUND_TRUTH = {
    "1": {"y": "2", "month": "aug", "day": "fri", "ffmc": "91", "dmc": "166.9", "dc": "752.6", "isi": "7.1",
          "temp": "25.9", "rh": "41", "wind": "3.6", "rain": "0", "area": "0"},
    "2": {"y": "2", "month": "feb", "day": "mon", "ffmc": "84", "dmc": "9.3", "dc": "34", "isi": "2.1",
          "temp": "13.9", "rh": "40", "wind": "5.4", "rain": "0", "area": "0"},
}

# Calendar words accepted by the month/day rule.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
