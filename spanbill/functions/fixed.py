"""Fixed values of the status vocabulary, the billing rules and the score rules.

Everything here is a constant that results depend on. It is kept in one place
so that a site with other codes can see what to change.
"""

# --- fixed values: status kinds -------------------------------------------
APPLIED = 1
ENROLL = 2
EXITS = (12, 3)
COACH = 6
DISTRICT = 7
DETAIL_ENROLLS = (13, 14, 15, 16)
AFTER_APPLICATION = (2, 3, 4, 5, 13, 14, 15, 16)

# --- fixed values: program names ------------------------------------------
PROGRAM_GTC = "GtC"
PROGRAM_YTC = "YtC"
PROGRAM_NONE = "na"
GTC_NAMES = ("gtc",)
YTC_NAMES = ("ytc", "yes", "map")

# --- fixed values: people entered for testing (compared without case) ------
TEST_FIRST_NAMES = ("test",)
TEST_LAST_NAMES = ("test", "testsd")

# --- fixed values: labels ---------------------------------------------------
EXIT_LEFT = "Left PCC Links"
EXIT_MOVED = "Transitioned"
EXIT_NONE = "None"
STATUS_EXITED = "Exited"

# --- fixed values: attendance weights ----------------------------------------
SMALL_WEIGHT = "0.333"
INTER_WEIGHT = "0.222"
LARGE_WEIGHT = "0.167"
CASE_SHARE = "0.10"
CASE_WEIGHT = "0.167"
CASE_WEIGHT_2017 = "0.0167"
HOURS_SMALL = "0.3497"
HOURS_INTER = "0.2387"
HOURS_LARGE = "0.1837"
HOURS_DIVISOR = "1.0167"

# --- fixed values: exit reason numbers that may be copied to a bill ----------
BILL_EXIT_REASONS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 51, 52, 53)

# --- fixed values: score rules -----------------------------------------------
OLD_PASS_SCORE = 410
NEW_PASS_SCORE = 145
NEW_TEST_FROM = "2014-01-01"
LAST_KNOWN_TEST = "2017-07-01"

# --- fixed values: interval outcome ------------------------------------------
REASON_GRADUATED = "Graduated"
REASON_MOVED = "Moved out of District/State (Specify District/State)"
REASON_ABSENT = "10 Days Absent"
REASON_NO_SHOW = "Accepted/No Show"
OUTCOME_STILL = "Still Attending"
OUTCOME_GRADUATED = "Graduated"
OUTCOME_TEST_PASSED = "Transferred to Yes & Earned GED"
OUTCOME_AGAIN = "Re-enrolled in "
OUTCOME_PROGRAM = "Transferred to "
OUTCOME_SCHOOL = "Transferred to another school"
OUTCOME_MOVED = "Moved out of district"
OUTCOME_ABSENT = "10 Days Absent"
OUTCOME_OTHER = "Exited Program"
OUTCOME_EXITED = "Exited"

# --- fixed values: billing status ----------------------------------------------
STATUS_NO_ATTRIBUTE = "Missing Banner Attribute"
STATUS_EXCLUDED_CLOSED = "Excluded"
STATUS_EXCLUDED = "Excluded from Billing"
STATUS_BILLED = "Billed"
STATUS_NO_CLASSES = "No Classes"
STATUS_REVIEWED = "Reviewed"
STATUS_OPEN = "In Progress"

# --- fixed values: courses ------------------------------------------------------
ESL_SUBJECTS = ("ESL", "ESOL")
ESOL = "ESOL"
FINAL_ESOL_TITLES = ("Level 8 Academic Reading", "Level 8 Academic Writing")
GRADE_POINTS = {"A": 4, "B": 3, "C": 2, "D": 1, "F": 0}

# --- fixed values: term labels ----------------------------------------------------
SEASONS = {1: "-Winter", 2: "-Spring", 3: "-Summer", 4: "-Fall"}

# --- labels of report columns ----------------------------------------------------
DISPLAY_LABELS = {
    "row_no": "Row",
    "g_number": "Student Number",
    "first_name": "First Name",
    "last_name": "Last Name",
    "email_main": "Email",
    "email_alt": "Other Email",
    "district_name": "District in Range",
    "start_in_range": "Enrolled in Range",
    "end_in_range": "Left in Range",
    "program_detail": "Program in Range",
    "coach_name": "Coach in Range",
    "current_status": "Status Now",
    "current_start": "Enrolled Now",
    "current_end": "Left Now",
    "last_school": "Last School",
    "ssid": "District Student Number",
    "exit_reason": "Reason for Leaving",
    "secondary_reason": "Further Reasons",
    "exit_note": "Note on Leaving",
    "dob": "Born",
    "risk_factors": "Risk Factors",
}
