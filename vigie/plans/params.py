"""Parameters shared by the registered queries (panel time runs 1995-01 .. 2001-08).

The reference's periods (train 2016-2018, test 2018, predict 2020-02, debt
snapshots 2020-07 and 2021-01) are moved into the panel's time range.
"""

TRAIN_FROM, TRAIN_TO = "1995-01-01", "1998-07-01"
TEST_FROM, TEST_TO = "1998-07-01", "2000-01-01"
PREDICT_ON = "2000-07-01"
JULY_SNAPSHOT = "2000-07-01"
LATEST_SNAPSHOT = "2001-01-01"

SAMPLE_N = 1_000          # reference default sample size
LARGE_SAMPLE_N = 5_000    # beyond what one task sorts
QUOTA_P = 0.2             # reference train oversampling
SEED = 7
RANGE_FROM, RANGE_TO = "1997-01-01", "1999-01-01"
N_FOLDS = 5

T_ROUGE, T_ORANGE = 0.75, 0.3   # thresholds of the reference's list example

# Fixed linear score used to make every post-model operator comparable with SQL:
# score = round(sigmoid(b0 + sum b_i * coalesce(x_i, 0)), 6).
FIXED_INTERCEPT = -2.0
FIXED_COEFS = (
    ("ratio_dette", 3.0),
    ("paydex_nb_jours", 0.015),
    ("endettement", -0.25),
    ("apart_heures_consommees", 0.004),
)

# Fixed explanation model (default-model feature groups): scaler (mean, std),
# weights per encoded column and intercept.  Values chosen for the panel.
EXPLAIN_INTERCEPT = -1.5
EXPLAIN_SCALER = {
    "financier_court_terme": (0.044, 0.025),
    "interets": (0.077, 0.02),
    "ca": (228725.0, 150000.0),
    "equilibre_financier": (-0.04, 0.04),
    "endettement": (4.5, 3.0),
    "degre_immo_corporelle": (0.23, 0.2),
    "liquidite_reduite": (0.78, 0.1),
    "poids_bfr_exploitation": (0.084, 0.03),
    "productivite_capital_investi": (0.82, 0.2),
    "rentabilite_economique": (0.33, 0.25),
    "rentabilite_nette": (0.55, 0.3),
    "apart_heures_consommees_cumulees": (309.0, 300.0),
    "apart_heures_consommees": (62.0, 50.0),
    "paydex_yoy": (0.0, 40.0),
    "ratio_dette": (0.3, 0.25),
    "avg_delta_dette_par_effectif": (0.0, 50.0),
}
EXPLAIN_LEVEL_COEFS = (-0.3, -0.2, 0.0, 0.1, 0.3, 0.5)
EXPLAIN_COEFS = {
    "financier_court_terme": 0.05,
    "interets": 0.1,
    "ca": -0.2,
    "equilibre_financier": -0.15,
    "endettement": -0.6,
    "degre_immo_corporelle": 0.05,
    "liquidite_reduite": -0.1,
    "poids_bfr_exploitation": 0.08,
    "productivite_capital_investi": -0.05,
    "rentabilite_economique": -0.12,
    "rentabilite_nette": 0.02,
    "apart_heures_consommees_cumulees": 0.25,
    "apart_heures_consommees": 0.2,
    "paydex_yoy": 0.3,
    "ratio_dette": 0.7,
    "avg_delta_dette_par_effectif": 0.15,
}
EXPLAIN_THRESH = 0.07
