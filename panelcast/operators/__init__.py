"""Panel operators: calendar, series windows, features, splits, profiles, scoring, report grid."""
