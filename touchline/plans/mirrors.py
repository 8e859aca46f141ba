"""The mirrored tables.

Column names, order and types are fixed values: the target tables have them.
"""

from touchline.functions import dates
from touchline.operators.mirror import Mirror

# Whole price book.
PRICE_BOOK = Mirror(
    columns=(
        "csg_codes string, online_desc string, statement_desc string, connection_type string, play string, "
        "tv string, phone string, modem string, download_speed string, upload_speed string, tv_box long, "
        "regular double, is_double_speed string, comments string, `stbs_for_migration-->` long, hd string, "
        "hd_rate long, dvr string, dvr_rate long, hubtv string, hubtv_rate long"
    ),
    slice_key=None,
)

# Package and service assets of a day.
ASSETS = Mirror(
    columns=(
        "pkg_cde_pks string, play string, pkg_descr string, serv_seq_no_pks int, serv_cde_pks string, "
        "serv_cde_online_descr string, chrg_pks double, service_code_length int, pkg_code_length int, "
        "service_code_lob string, dt string"
    ),
    ms_added=("dt",),
)

# Customer services and rates of a day.
CUSTOMER_RATES = Mirror(
    columns=(
        "as_of timestamp, prin_sbb int, agnt_sbb int, sub_acct_no_sbb long, res_name_sbb string, "
        "home_phone_sbb long, bus_phone_sbb long, vip_flg_sbb string, cyc_cde_sbb int, cust_typ_sbb string, "
        "cur_bal_sbb double, connect_dte_sbb timestamp, email string, cs string, tenure double, "
        "addr1_hse string, res_addr_2_hse string, res_city_hse string, postal_code int, map_cde_hse string, "
        "bridger_addr_hse string, video int, video_tier string, primary_video_services string, "
        "add_video_services string, hsd int, hsd_speed string, hsd_upload_speed string, voice int, "
        "play_type string, hub_tv int, cable_cards int, dta int, dvr int, hd int, sd int, cpe string, "
        "video_chrg double, hsd_chrg double, voice_chrg double, bill_code string, drop_type string, "
        "stb_chrg double, bill_from_dte_sbb timestamp, delq_stat_sbb string, joint_customer string, "
        "welcome_offer string, wireless_cust_id_pstpd string, wireless_cust_id_prepd string, "
        "ls_pay_dte_sbb timestamp, ls_pay_amt_sbb double, delinquency_days int, delinquency_amt double, "
        "acp string, dt string"
    ),
    account_from="sub_acct_no_sbb",
    timestamps_as_ms=True,
    ms_added=("dt",),
)

# Customer interactions of a day, or of all days after one.
INTERACTIONS = Mirror(
    columns=(
        "interaction_id string, interaction_start_time timestamp, interaction_end_time timestamp, "
        "interaction_channel string, interaction_phone_no string, interaction_agent_id string, "
        "interaction_agent_name string, interaction_language string, interaction_direction string, "
        "interaction_product_id string, interaction_purpose_descrip string, interaction_status string, "
        "other_interaction_info10 string, interaction_voice_rec_id string, interaction_web_log_detail string, "
        "interaction_activity_log_dtl string, survey_id string, survey_channel_id string, "
        "customer_satisfaction_grade string, net_promoter_score double, sentiment_result_description string, "
        "issue_resolution_flag string, abandonment_rate int, other_interaction_info1 string, customer_id string, "
        "source_system_name string, data_creation_timestamp timestamp, run_timestamp timestamp, run_id long, "
        "valid_from_timestamp timestamp, account_id string, other_interaction_info2 timestamp, "
        "other_interaction_info3 timestamp, other_interaction_info4 string, other_interaction_info5 string, "
        "other_interaction_info6 string, other_interaction_info7 string, other_interaction_info8 string, "
        "other_interaction_info9 string, other_interaction_info11 string, other_interaction_info12 string, "
        "other_interaction_info13 string, org_cntry string, src_file_name string, org_id string, "
        "interaction_type_id string, interaction_outcome_date timestamp, account_type string, dt string"
    ),
    account_from="account_id",
    timestamps_as_ms=True,
    ms_added=("dt",),
)

# Service-order headers of a day.
SERVICE_ORDERS = Mirror(
    columns=(
        "org_id string, org_cntry string, order_id string, order_start_date timestamp, completed_date timestamp, "
        "cancelled_date timestamp, order_status string, sales_rep_id string, sales_rep_name string, "
        "csr_id string, csr_name string, channel_identifier string, channel_desc string, channel_type string, "
        "channel_sub_type string, order_contact_name string, order_contact_details string, "
        "order_location string, order_type string, network_type string, appointment_required string, "
        "lob_vo_count double, lob_bb_count double, lob_tv_count double, lob_other_count double, "
        "cease_reason_code string, cease_reason_desc string, cease_reason_group string, "
        "cancel_reason_code string, cancel_reason_desc string, currency_code string, "
        "estimated_rc_amt_local double, estimated_nrc_amt_local double, account_id long, account_name string, "
        "account_type string, customer_id long, source_system_name string, data_creation_timestamp timestamp, "
        "run_timestamp timestamp, run_id int, cust_id_type string, cust_id_value string, action_date timestamp, "
        "dt string, hr string"
    ),
    account_from="account_id",
    timestamps_as_ms=True,
    ms_added=("dt",),
)

# Order activity by change date.
ORDER_ACTIVITY = Mirror(
    columns=(
        "ls_chg_dte_ocr string, create_dte_ocr string, ord_stat_ocr string, order_no_ooi long, acct_type string, "
        "sub_acct_no_ooi long, disco_rsn_sbb string, disco_dte_sbb string, order_create_operator string, "
        "order_salesrep long, bef_lob string, aft_lob string, bef_value_amt double, month_amt_ocr double, "
        "ord_typ string, cable_up string, internet_up string, phone_up string, cable_down string, "
        "internet_down string, phone_down string, bef_video long, bef_hsd long, bef_voice long, aft_video long, "
        "aft_hsd long, aft_voice long, tenure long, tc_count long, cit_calls_count long, adjustment_count long, "
        "cs string, vol_disco_rsn string, system string, city string, node string, map_cde string, "
        "salesrep_area string, multiple_np long, oper_area string, stb_sc string"
    ),
    slice_key="ls_chg_dte_ocr",
    account_from="sub_acct_no_ooi",
    drop_account_from=True,
    ms_added=("ls_chg_dte_ocr", "create_dte_ocr", "disco_dte_sbb"),
)

# Communications history of a day.
HISTORY_DAY = Mirror(
    columns=(
        "account_id string, channel string, campaign string, use_case string, regime string, sent_dt timestamp, "
        "contact_dt timestamp, conv_dt timestamp, conv_type string, rec_dt date, order_id string, "
        "conv_use_case_category string, dt string"
    ),
    sources={
        "campaign": "campaign_name",
        "conv_dt": "conversion_dt",
        "conv_type": "conversion_type",
        "rec_dt": "rec_date",
        "conv_use_case_category": "conv_use_case_cat",
        "dt": "day",
    },
    slice_key="day",
    ms_added=("dt",),
    ms_instead=("sent_dt", "contact_dt", "conv_dt", "rec_dt"),
    patterns={"rec_dt": ("yyyy-M-d", *dates.DAY_FIRST_PATTERNS)},
)

# Communications history with conversion flag, the trailing two weeks.
HISTORY_WINDOW = Mirror(
    columns=(
        "account_id string, channel string, campaign string, use_case string, regime string, sent_dt timestamp, "
        "contact_dt timestamp, conv_dt string, conv_type string, rec_dt date, order_id string, "
        "conv_use_case_category string, conv_flg boolean, dt string"
    ),
    sources={
        "campaign": "campaign_name",
        "conv_dt": "conversion_dt",
        "conv_type": "conversion_type",
        "rec_dt": "rec_date",
        "conv_use_case_category": "conv_use_case_cat",
        "dt": "day",
    },
    slice_key="day",
    ms_added=("dt",),
    ms_instead=("sent_dt", "contact_dt", "conv_dt", "rec_dt"),
    patterns={"rec_dt": ("yyyy-M-d", *dates.DAY_FIRST_PATTERNS)},
)

# All current offers.
OFFERS_LATEST = Mirror(
    columns=(
        "sub_acct_no string, offer_type string, channel string, next_best_action_date date, use_case string, "
        "pkg_cde string, online_descr_pkg string, smt_descr_pkg string, hsd_service string, "
        "bundlecharge_csg double, recommendedpkg string, tocsgcodefriendlyname string, "
        "to_online_descr_pkg string, to_smt_descr_pckg string, to_bundlecharge_csg double, discount double, "
        "date_recomm date, rank int, pkg_type string, stb string, additional_charge double, delta_arpu double, "
        "source string, regime string, reward double, week_day string, time_frame string, "
        "additional_param_1 string, additional_param_2 string, additional_param_3 string, "
        "additional_param_4 string, additional_param_5 string, additional_param_6 string, "
        "additional_param_7 string, additional_param_8 string, additional_param_9 string, "
        "additional_param_10 string, id_oferta_int long, link string, link_dt date, link_exp_dt date"
    ),
    sources={
        "date_recomm": "date",
        "link_dt": "link_generated_dt",
        "link_exp_dt": "link_expiration_dt",
    },
    slice_key=None,
    account_from="sub_acct_no",
    ms_added=("date_recomm", "next_best_action_date"),
    ms_in_place=("link_dt", "link_exp_dt"),
    as_timestamps=("date_recomm", "next_best_action_date"),
)

# Offers that arrived on a day.
OFFERS_ARRIVED = Mirror(
    columns=(
        "sub_acct_no string, pkg_cde string, online_descr_pkg string, smt_descr_pkg string, hsd_service string, "
        "bundlecharge_csg double, recommendedpkg string, tocsgcodefriendlyname string, "
        "to_online_descr_pkg string, to_smt_descr_pckg string, to_bundlecharge_csg string, discount string, "
        "dt string, rank int, pkg_type string, stb string, additional_charge double, delta_arpu string, "
        "source string, regime string, reward double, use_case string, offer_type string, channel string, "
        "week_day string, next_best_action_date string, time_frame string, additional_param_1 string, "
        "additional_param_2 string, additional_param_3 string, additional_param_4 string, "
        "additional_param_5 string, additional_param_6 string, additional_param_7 string, "
        "additional_param_8 string, additional_param_9 string, additional_param_10 string, id_oferta_int long"
    ),
    sources={
        "dt": "date",
    },
    slice_key="day",
    account_from="sub_acct_no",
    ms_added=("dt", "next_best_action_date"),
    patterns={c: ("yyyy-M-d", *dates.DAY_FIRST_PATTERNS) for c in ("dt", "next_best_action_date")},
)

# Monthly win-back list.
WINBACK = Mirror(
    columns=(
        "sub_acct_no_sbb string, nombre string, email string, home_phone_sbb string, disconnection_date string, "
        "bef_value_amt double, disco_rsn_sbb string, hasvideo boolean, hashsd boolean, hasvoice boolean, "
        "internet_down string, cable_down string, phone_down string"
    ),
    sources={
        "disconnection_date": "disconnection date",
    },
    slice_key=None,
    account_from="sub_acct_no_sbb",
    ms_added=("disconnection_date",),
)
