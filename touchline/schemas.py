"""Declared tables: event feeds, communications history and its companions, arriving files.

The column names, their order and types below are fixed values: the stored tables and the files of partner
systems have them.
"""

GEO = (
    "struct<postal_code:string,latitude:string,longitude:string,accuracy_radius:string,"
    "continent_code:string,country_iso_code:string,city_name:string,time_zone:string>"
)

# Event feeds.
FEEDS = {
    "campaigns": (
        "id long, name string, version_name string, language string, category_id int, parent_campaign_id long, "
        "type string, sub_type string, program_id long, partitiontime timestamp, event_time timestamp, "
        "loaded_at timestamp"
    ),
    "sends": (
        "contact_id long, launch_id long, campaign_type string, domain string, campaign_id long, message_id int, "
        "event_time timestamp, customer_id long, partitiontime timestamp, loaded_at timestamp"
    ),
    "opens": (
        "contact_id long, launch_id long, domain string, email_sent_at timestamp, campaign_type string, "
        f"geo {GEO}, platform string, md5 string, is_mobile string, is_anonymized string, uid string, ip string, "
        "user_agent string, generated_from string, campaign_id string, message_id string, event_time timestamp, "
        "customer_id string, partitiontime timestamp, loaded_at timestamp"
    ),
    "bounces": (
        "contact_id long, launch_id long, domain string, email_sent_at timestamp, campaign_type string, "
        "bounce_type string, campaign_id long, message_id int, event_time timestamp, customer_id long, "
        "partitiontime timestamp, loaded_at timestamp, dsn_reason string"
    ),
    "cancels": (
        "contact_id long, launch_id long, reason string, campaign_type string, suite_type string, "
        "suite_event string, campaign_id long, message_id int, event_time timestamp, customer_id long, "
        "partitiontime timestamp, loaded_at timestamp"
    ),
    "clicks": (
        "contact_id long, launch_id long, domain string, email_sent_at timestamp, campaign_type string, "
        f"geo {GEO}, platform string, md5 string, is_mobile string, is_anonymized string, uid string, ip string, "
        "user_agent string, section_id string, link_id string, category_id string, is_img string, "
        "campaign_id string, message_id string, event_time timestamp, customer_id string, partitiontime timestamp, "
        "loaded_at timestamp, category_name string, link_name string, link_analysis_name string, "
        "relative_link_id string"
    ),
    "complaints": (
        "contact_id long, launch_id long, domain string, email_sent_at timestamp, campaign_type string, "
        "campaign_id long, message_id int, event_time timestamp, customer_id long, partitiontime timestamp, "
        "loaded_at timestamp"
    ),
    "unsubscribes": (
        "contact_id string, launch_id string, domain string, email_sent_at timestamp, campaign_type string, "
        "source string, campaign_id string, message_id string, event_time timestamp, customer_id string, "
        "loaded_at timestamp"
    ),
}

# The communications history, one row per account, channel, campaign and send or attempt.
HISTORY = (
    "account_id string, sub_acct_no_sbb string, use_case string, campaign_name string, contact_id long, "
    "campaign_id long, comm_dt date, sent_dt timestamp, cancel_dt timestamp, cancel_reason string, "
    "bounce_dt timestamp, dsn_reason string, bounce_type string, open_dt timestamp, click_dt timestamp, "
    "clicks_count int, contact_dt timestamp, id_oferta_int long, offer_type string, rec_date date, regime string, "
    "link string, link_generated_dt date, link_expiration_dt date, order_id string, conv_use_case_cat string, "
    "conversion_dt timestamp, conversion_type string, program_id int, conv_flg boolean, month string, day string, "
    "channel string"
)
HISTORY_KEYS = ("month", "day", "channel")
SIMPLE_HISTORY = (
    "contact_id long, channel string, campaign_id long, campaign_name string, event_time timestamp, launch_id long"
)

# Channels from first to last choice for a conversion, with every spelling in use.
CHANNEL_WEIGHTS = {
    "email": 1,
    "Outbound call": 2,
    "Outbound_call": 2,
    "CALLCENTER": 2,
    "WhatsApp": 3,
    "Inbound call": 4,
}

# Call dispositions that count as a contact.
CONTACTED_DISPOSITIONS = ("OFITi- Cliente acepta oferta", "Cliente no acepta ninguna oferta")

# Arriving files after typing.
OFFERS_IN = (
    "sub_acct_no string, pkg_cde string, online_descr_pkg string, smt_descr_pkg string, hsd_service string, "
    "bundlecharge_csg double, recommendedpkg string, tocsgcodefriendlyname string, to_online_descr_pkg string, "
    "to_smt_descr_pckg string, to_bundlecharge_csg string, discount string, date string, rank string, "
    "pkg_type string, stb string, additional_charge double, delta_arpu string, source string, regime string, "
    "reward double, use_case string, offer_type string, channel string, week_day string, "
    "next_best_action_date date, time_frame string, additional_param_1 string, additional_param_2 string, "
    "additional_param_3 string, additional_param_4 string, additional_param_5 string, additional_param_6 string, "
    "additional_param_7 string, additional_param_8 string, additional_param_9 string, additional_param_10 string"
)
OFFER_FILE = (
    "SUB_ACCT_NO long, OLD_SPEED string, FROM_CSG_CODE long, TO_CSG_CODE string, NEW_SPEED string, "
    "PAYMENT_DIF long, DISCOUNT long, SUBLINE_1 string, CALL_TO_ACTION string, SUBJECT_CODE string, "
    "TEMPLATE_TYPE long, TIME_FRAME string, REGIME string, DATE string, STB string"
)
CALL_FEEDBACK = (
    "account_id string, cuenta string, Intento_discado_1 date, Intento_discado_2 date, Intento_discado_3 date, "
    "Hora_llamada string, Disposicion string, Comentarios string, csv_origen string"
)
CONVERSIONS = "account_id string, conv_use_case_cat string, order_id string, conv_dte string, conv_type string"
