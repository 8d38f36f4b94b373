"""Columns each table query returns; a trailing ``~`` marks a double, compared at six places."""

SHAPES = {
    "raw_accounts": "customer_id account_id account_type currency balance~ credit_limit~ interest_rate~ opened_date "
                    "status branch_code bronze_id",
    "raw_transactions": "customer_id transaction_id account_id transaction_date amount~ currency transaction_type "
                        "category merchant channel status description bronze_id",
    "raw_loans": "customer_id loan_id loan_type currency principal~ outstanding_balance~ interest_rate~ term_months "
                 "monthly_payment~ start_date end_date status days_past_due collateral_type bronze_id",
    "stg_accounts": "account_id customer_id account_type currency balance~ credit_limit~ interest_rate~ opened_date "
                    "status branch_code bronze_id",
    "stg_transactions": "transaction_id customer_id account_id transaction_date amount~ currency transaction_type "
                        "category merchant channel status description bronze_id",
    "stg_loans": "loan_id customer_id loan_type currency principal~ outstanding_balance~ interest_rate~ term_months "
                 "monthly_payment~ start_date end_date status days_past_due collateral_type bronze_id",
    "dim_customer": "customer_id first_name last_name email phone_number date_of_birth age age_bucket gender "
                    "nationality city country address is_geo_valid lat~ lon~ registration_date tenure_months "
                    "tenure_bucket kyc_status risk_score~ customer_segment relationship_manager status",
    "dim_credit_info": "customer_id credit_score_raw is_credit_score_valid credit_score currency utilization_pct_raw~ "
                       "is_utilization_pct_valid utilization_pct~ total_limit~ total_used~ num_credit_accounts "
                       "oldest_account_age_months late_payments_12m inquiries_6m bankruptcy_flag",
    "dim_digital_engagement": "customer_id mobile_app_registered web_banking_registered last_login_date "
                              "avg_monthly_logins preferred_channel push_notifications paperless_statements",
    "dim_account": "account_id customer_id account_type currency balance~ credit_limit~ interest_rate~ opened_date "
                   "status branch_code account_age_months",
    "dim_loan": "loan_id customer_id loan_type currency principal~ outstanding_balance~ interest_rate~ term_months "
                "monthly_payment~ start_date end_date status days_past_due collateral_type loan_age_months "
                "remaining_term_months principal_repaid~ principal_repaid_pct~",
    "dim_geography": "country_code country_name region default_currency",
    "dim_date": "date_day year quarter month week_of_year day_of_month day_of_week_num day_of_year month_name "
                "month_name_short day_name day_name_short is_weekend year_month_key year_quarter_key "
                "year_month_label year_quarter_label week_start month_start quarter_start year_start",
    "fct_transactions": "transaction_id customer_id account_id transaction_date amount~ currency transaction_type "
                        "category merchant channel status description is_failed day_of_week bronze_id",
    "fct_loans": "loan_id customer_id start_date end_date loan_type currency collateral_type term_months principal~ "
                 "outstanding_balance~ interest_rate~ interest_rate_decimal~ monthly_payment~ status days_past_due "
                 "bronze_id",
    "agg_customer_activity": "customer_id accounts_count transactions_count loans_count total_products",
    "int_loan_portfolio_metrics": "loan_id customer_id loan_type currency status collateral_type principal~ "
                                  "outstanding_balance~ interest_rate~ interest_rate_decimal~ monthly_payment~ "
                                  "days_past_due term_months start_date end_date is_delinquent is_default dpd_bucket "
                                  "monthly_interest_accrued~",
    "int_customer_risk_profile": "customer_id country customer_segment kyc_status status risk_score~ risk_bucket "
                                 "credit_score credit_score_bucket utilization_pct~ utilization_bucket total_limit~ "
                                 "total_used~ late_payments_12m bankruptcy_flag is_delinquent_customer "
                                 "is_default_customer loans_count delinquent_loans_count default_loans_count",
    "int_customer_monthly_revenue": "customer_id total_fees_paid_lifetime_native~ total_fees_paid_lifetime_usd~ "
                                    "monthly_fee_revenue_native~ monthly_fee_revenue_usd~ "
                                    "monthly_interest_revenue_native~ monthly_interest_revenue_usd~ "
                                    "total_monthly_revenue_native~ total_monthly_revenue_usd~",
    "mart_customer_360": "customer_id country city gender age age_bucket customer_segment tenure_months tenure_bucket "
                         "kyc_status status risk_score~ risk_bucket credit_score credit_score_bucket utilization_pct~ "
                         "utilization_bucket total_limit~ total_used~ late_payments_12m bankruptcy_flag "
                         "mobile_app_registered web_banking_registered accounts_count loans_count "
                         "transactions_count total_products total_fees_paid_lifetime~ monthly_fee_revenue~ "
                         "monthly_interest_income~ total_revenue_monthly~",
    "mart_acquisition_trend": "month year month_number month_label new_customers cumulative_customers mom_growth_pct~",
    "mart_revenue_by_segment_usd": "customer_segment customer_count total_revenue_usd~ avg_revenue_per_customer_usd~ "
                                   "total_fee_revenue_usd~ total_interest_revenue_usd~ "
                                   "avg_fee_revenue_per_customer_usd~ avg_interest_revenue_per_customer_usd~ "
                                   "fee_revenue_share~",
    "mart_revenue_monthly_by_segment_usd": "revenue_month customer_segment fee_revenue_usd~ interest_revenue_usd~ "
                                           "total_revenue_usd~",
    "mart_account_mix": "country account_type currency accounts_count accounts_with_balance total_balance~ "
                        "avg_balance~ min_balance~ max_balance~ pct_of_country_accounts~ pct_of_total_accounts~",
    "mart_delinquency_by_segment": "customer_segment customer_count customers_with_loans customers_without_loans "
                                   "delinquent_customers default_customers delinquency_rate~ default_rate~",
    "mart_credit_score_by_country": "country credit_score_bucket customer_count avg_credit_score~ "
                                    "bucket_share_within_country~",
    "mart_utilization_vs_delinquency": "utilization_bucket customer_count customers_with_loans delinquent_customers "
                                       "default_customers delinquency_rate~ default_rate~ avg_utilization_pct~ "
                                       "avg_credit_score~",
    "mart_risk_buckets": "risk_bucket customer_count avg_risk_score~ bucket_share~ customers_with_loans "
                         "delinquency_rate~ default_rate~ avg_credit_score~ avg_utilization_pct~",
    "mart_loan_dpd": "loan_type dpd_bucket currency loan_count total_outstanding_balance~ avg_outstanding_balance~ "
                     "avg_days_past_due~ bucket_share_within_type_currency~",
    "mart_loan_composition": "loan_type status currency loan_count total_principal~ total_outstanding_balance~ "
                             "avg_outstanding_balance~ avg_interest_rate~ total_monthly_interest_accrued~ "
                             "delinquent_count default_count outstanding_share_within_type_currency~",
    "mart_tx_by_channel": "channel currency tx_count completed_tx_count failed_tx_count total_value~ avg_ticket~ "
                          "failed_rate~",
    "mart_tx_by_category": "category currency tx_count completed_tx_count total_value~ avg_ticket~",
    "mart_tx_by_dow": "day_of_week day_of_week_name currency tx_count completed_tx_count total_value~ avg_ticket~",
    "mart_international_transfers": "origin_country tx_currency tx_count international_tx_count domestic_tx_count "
                                    "completed_tx_count completed_international_tx_count international_share~ "
                                    "total_value~ total_international_value~ avg_ticket~ avg_international_ticket~",
    "mart_top_merchants": "merchant currency top_category tx_count total_value~ avg_ticket~ min_ticket~ max_ticket~ "
                          "rank_by_value_within_currency rank_by_count_within_currency",
    "mart_digital_adoption_by_segment": "customer_segment customer_count mobile_adoption_rate~ web_adoption_rate~ "
                                        "any_digital_adoption_rate~ push_notifications_rate~ paperless_rate~ "
                                        "avg_monthly_logins~",
    "mart_channel_preference_by_age": "age_bucket preferred_channel customer_count bucket_share_within_age~",
}

# Query name -> table it returns.
TABLE_QUERIES = {
    "jsn6_accounts": "raw_accounts",
    "jsn6_transactions": "raw_transactions",
    "jsn6_loans": "raw_loans",
    "slv1_stg_accounts": "stg_accounts",
    "slv2_stg_transactions": "stg_transactions",
    "slv3_stg_loans": "stg_loans",
    "slv4_dim_customer": "dim_customer",
    "slv5_dim_credit_info": "dim_credit_info",
    "slv6_dim_digital_engagement": "dim_digital_engagement",
    "slv7_dim_account": "dim_account",
    "slv8_dim_loan": "dim_loan",
    "slv11_fct_transactions": "fct_transactions",
    "slv12_fct_loans": "fct_loans",
    "slv13_agg_customer_activity": "agg_customer_activity",
    "int1_loan_portfolio_metrics": "int_loan_portfolio_metrics",
    "int2_customer_risk_profile": "int_customer_risk_profile",
    "int3_customer_monthly_revenue": "int_customer_monthly_revenue",
    "gld1_customer_360": "mart_customer_360",
    "gld2_acquisition_trend": "mart_acquisition_trend",
    "gld3_revenue_by_segment_usd": "mart_revenue_by_segment_usd",
    "gld4_revenue_monthly_by_segment_usd": "mart_revenue_monthly_by_segment_usd",
    "gld5_account_mix": "mart_account_mix",
    "gld6_delinquency_by_segment": "mart_delinquency_by_segment",
    "gld7_credit_score_by_country": "mart_credit_score_by_country",
    "gld8_utilization_vs_delinquency": "mart_utilization_vs_delinquency",
    "gld9_risk_buckets": "mart_risk_buckets",
    "gld10_loan_dpd": "mart_loan_dpd",
    "gld11_loan_composition": "mart_loan_composition",
    "gld12_tx_by_channel": "mart_tx_by_channel",
    "gld13_tx_by_category": "mart_tx_by_category",
    "gld14_tx_by_dow": "mart_tx_by_dow",
    "gld15_international_transfers": "mart_international_transfers",
    "gld16_top_merchants": "mart_top_merchants",
    "gld17_digital_adoption_by_segment": "mart_digital_adoption_by_segment",
    "gld18_channel_preference_by_age": "mart_channel_preference_by_age",
}
