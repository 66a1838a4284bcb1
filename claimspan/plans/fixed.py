"""Labels and bounds the reports use unless told otherwise."""

# Names and limits that readers of the reports rely on.

# Loss ratio in percent: each label holds above its bound.
LOSS_BANDS = ((100, "LOSS MAKING"), (80, "HIGH RISK"), (60, "MODERATE"))
LOSS_OTHERWISE = "PROFITABLE"

# Insurer grades: approval % above and days below; rejection % above.
GRADE_A, GRADE_A_LABEL = (60, 30), "A - EXCELLENT"
GRADE_B, GRADE_B_LABEL = (50, 45), "B - GOOD"
GRADE_D, GRADE_D_LABEL = 20, "D - POOR"
GRADE_C_LABEL = "C - AVERAGE"

# Hospital and insurer pairs: rejection % and days.
PAIR_POOR, PAIR_POOR_LABEL = (25, 45), "POOR"
PAIR_BELOW, PAIR_BELOW_LABEL = (15, 30), "BELOW AVERAGE"
PAIR_BEST, PAIR_BEST_LABEL = (10, 15), "EXCELLENT"
PAIR_LABEL = "AVERAGE"

# Risk levels of patients and of frequent claims.
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "HIGH RISK", "MEDIUM RISK", "LOW RISK"
FREQUENT_DAYS, FREQUENT_MEDIUM, FREQUENT_HIGH = 90, 3, 5

# Risk score: conditions by severity, and points above each count.
SEVERE_CONDITIONS = ("Diabetes+Hypertension", "Heart Disease", "COPD")
MODERATE_CONDITIONS = ("Diabetes", "Hypertension", "Obesity")
NO_CONDITION = "None"
CONDITION_POINTS = (25, 15, 0, 10)  # severe, moderate, none, any other
FULL_AGE, AGE_POINTS = 60, 20
CLAIM_POINTS, CLAIM_BASE = ((15, 20), (10, 15), (5, 10)), 5
EMERGENCY_POINTS = ((3, 15), (1, 10))
READMISSION_POINTS = ((2, 20), (0, 10))
HIGH_SCORE, MEDIUM_SCORE = 65, 40

# Z-scores beyond these are flagged.
OUTLIER_Z, EXTREME_Z = 2, 3
EXTREME_LABEL = "EXTREME OUTLIER - Investigate"
OUTLIER_LABEL = "HIGH OUTLIER - Review"
LOW_LABEL = "UNUSUALLY LOW - Verify"
NORMAL_LABEL = "NORMAL"

# The patients whose running totals are shown.
DEFAULT_PATIENTS = ("P00001", "P00002", "P00003")
