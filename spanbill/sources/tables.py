"""The schemas of the domain tables, stated, not inferred.

Result tables are published (``published``); a keyed update is a new snapshot
(``operators.snapshots``), which is published as the next version.
"""

from __future__ import annotations

import re

MONEY = "decimal(10,4)"

SCHEMAS = {
    "status": "status_id long, person_id long, kind int, program string, status_date timestamp_ntz, "
    "undone_by long, notes string",
    "contact": "person_id long, g_number string, first_name string, last_name string, middle_name string, dob date, "
    "gender string, email_main string, email_alt string, ssid string, last_school string, "
    "hs_credits decimal(6,2), hs_gpa decimal(4,2)",
    "kinds": "kind int, kind_text string",
    "reasons": "reason_id int, reason_text string, reason_num int",
    "status_reason": "status_id long, reason_id int",
    "secondary": "status_id long, reason_id int",
    "status_district": "status_id long, district_id int, district_student_number string",
    "districts": "district_id int, district_name string",
    "status_coach": "status_id long, coach_id long",
    "coaches": "coach_id long, coach_name string",
    "risks": "person_id long, risk_id int",
    "risk_factors": "risk_id int, risk_name string",
    "comments": "comment_id long, person_id long, comment_text string",
    "calendar": "term int, program_year string, program_quarter int, term_begin date, term_end date, next_begin date",
    "cycles": "cycle_id long, billing_type string, start_date date, term int, program_year string, close_date date, "
    f"max_days_period {MONEY}, max_credits {MONEY}, max_days_year {MONEY}, starting_cycle_id long, "
    "ending_cycle_id long, latest_report_id long",
    "bills": "bill_id long, person_id long, pidm long, g_number string, program string, term int, start_date date, "
    "end_date date, enrolled_date date, exit_date date, exit_code int, district_id int, include_flag int, "
    f"reviewed_flag int, adjusted_days {MONEY}, max_days_period {MONEY}, max_days_month {MONEY}, "
    f"generated_units {MONEY}, generated_over_units {MONEY}, generated_amount {MONEY}, generated_over {MONEY}, "
    f"corrected_units {MONEY}, corrected_over_units {MONEY}, corrected_amount {MONEY}, corrected_over {MONEY}, "
    f"final_units {MONEY}, final_over_units {MONEY}, final_amount {MONEY}, final_over {MONEY}, "
    f"post_amount {MONEY}, post_over {MONEY}, updated_at timestamp, updated_by string, "
    f"adjusted_ind_hours {MONEY}, billing_notes string, billing_status string, cm_percent decimal(5,3), credits_entered int, "
    f"created_by string, date_created date, error_message string, exit_status_reason_id int, inter_percent decimal(5,3), "
    f"large_percent decimal(5,3), small_percent decimal(5,3), max_credits {MONEY}, max_days_year {MONEY}, review_notes string, "
    "coach_review_flag int",
    "items": "item_id long, bill_id long, crn long, attendance decimal(12,3), credits decimal(6,2), "
    "include_flag int, scenario_name string, ind_percent decimal(5,3), small_percent decimal(5,3), "
    "inter_percent decimal(5,3), large_percent decimal(5,3), updated_at timestamp, updated_by string, created_by string, "
    "course_number string, date_created date, max_possible_attendance decimal(12,3), subject string, taken_previous_term int, title string",
    "course_scenarios": "crn long, term int, scenario_id int",
    "scenarios": "scenario_id int, scenario_name string, ind_percent decimal(5,3), small_percent decimal(5,3), "
    "inter_percent decimal(5,3), large_percent decimal(5,3)",
    "courses": "student string, term int, crn long, subject string, course_number string, course_level string, "
    "title string, credits decimal(6,2), grade string, passed string",
    "term_results": "student string, term int, gpa decimal(10,2), attempted decimal(10,2), earned decimal(10,2)",
    "audit_log": "table_name string, id_column string, id_value long, column_name string, old_value string, "
    "new_value string, action string, changed_at timestamp, changed_by string",
}

#: Columns whose changes the audit of bills and of items records.
AUDITED = {
    "bills": [
        "adjusted_days", "adjusted_ind_hours", "g_number", "end_date", "billing_notes", "start_date", "billing_status", "exit_code",
        "bill_id", "cm_percent", "person_id", "corrected_amount", "corrected_units", "corrected_over", "corrected_over_units",
        "created_by", "credits_entered", "date_created", "district_id", "enrolled_date", "error_message", "exit_date",
        "exit_status_reason_id", "final_amount", "final_units", "final_over", "final_over_units", "generated_amount",
        "generated_units", "generated_over", "generated_over_units", "include_flag", "inter_percent", "large_percent",
        "max_credits", "max_days_period", "max_days_month", "max_days_year", "pidm", "post_amount", "program", "review_notes",
        "coach_review_flag", "small_percent", "term",
    ],
    "items": [
        "attendance", "bill_id", "item_id", "created_by", "credits", "crn", "course_number", "date_created", "include_flag",
        "ind_percent", "inter_percent", "large_percent", "max_possible_attendance", "scenario_name", "small_percent", "subject",
        "taken_previous_term", "title",
    ],
}


def types(name: str) -> dict[str, str]:
    """Stated type of each column of a table."""
    return dict(c.strip().split(" ", 1) for c in re.split(r",(?![^(]*\))", SCHEMAS[name]))
