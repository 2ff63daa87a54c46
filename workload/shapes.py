"""Lines made of the pieces of an event (see ``render.with_parts``).

The SQL of a shape runs in both engines; it is used to render lines, and on the
other side only where the line itself is part of the expected result.
"""

NEW_FAMILY = {
    "utc": "concat('<',pri,'>1 ',iso,'.',us,'Z ',host,' ',event_type,' ',event_id,' ID',event_id%50,' - ',props)",
    "offset": "concat('<',pri,'>1 ',iso7,'.',us,'-07:00 ',host,' ',event_type,' - - [meta@32473 id=\"',event_id,'\"] ',props)",
    "compact": "concat('<',pri,'>2 ',iso7,',',us,'-0700 ',host,' ',event_type,' -x - - ',props)",
    "bare": "concat('<',pri,'>1 ',iso,'Z ',host,' ',event_type,' - ID -')",
    "empty_words": "concat('<',pri,'>1 ',iso,'.',substr(us,1,3),'Z   - - ',props)",
}

OLD_FAMILY = {
    "iso": "concat('<',pri,'>',iso,'.',substr(us,1,3),'Z ',host,' ',event_type,'[',event_id,']: ',props)",
    "zone_year": "concat('<',pri,'>',mon,' ',hms,' UTC 2024 ',host,' ',event_type,': ',props)",
    "short": "concat('<',pri,'>',mon,' ',hms,' ',host,' ',event_type,' ',props)",
    "weekday": "concat('<',pri,'>',dow,' ',mon,' ',hms,' 2024 ',host,' ',event_type,'[',event_id,'] ',props)",
    "no_host": "concat('<',pri,'>',mon,' ',hms,' ',event_type,': ',props)",
}

# Every accepted layout of a timestamp: name to the text of the stamp.
STAMPS = {
    **{
        f"iso_{digits}_{zone}": f"concat({'iso' if shift == 'Z' else 'iso7'}{fraction},'{shift}')"
        for digits, fraction in (
            (9, ",'.',us,'987'"), (6, ",'.',us"), (3, ",',',substr(us,1,3)"), (0, ""),
        )
        for zone, shift in (("colon", "-07:00"), ("plain", "-0700"), ("utc", "Z"))
    },
    "full_offset": "concat(dow7,', ',day7,' ',substr(mon7,1,3),' ',year7,' ',hms7,' -0700')",
    "full_zone": "concat(dow,', ',day2,' ',substr(mon,1,3),' 2024 ',hms,' CST')",
    "zone_year": "concat(upper(mon),' ',hms,' GMT 2024')",
    "weekday": "concat(dow,' ',mon,' ',hms,' 2024')",
    "short": "concat(lower(mon),' ',hms)",
}

# Broken lines: name to (code, SQL).
BROKEN = {
    "no_priority": (1, "concat('no priority ',props)"),
    "open_priority": (4, "concat('<',pri,' ',host)"),
    "empty_priority": (2, "concat('<>',props)"),
    "word_priority": (3, "concat('<',event_type,'>',props)"),
    "huge_priority": (3, "concat('<9223372036854775808',pri,'>',props)"),
    "spaced_priority": (3, "concat('< ',pri,'>',iso,'Z ',host,' app: ',props)"),
    "nil_date": (7, "concat('<',pri,'>1 - ',host,' app 1 - - ',props)"),
    "word_date": (8, "concat('<',pri,'>not-a-date ',host,' app: ',props)"),
    "two_digit_version": (8, "concat('<',pri,'>10 ',iso,'Z ',host,' app 1 - - ',props)"),
    "one_digit_fraction": (8, "concat('<',pri,'>1 ',iso,'.',substr(us,1,1),'Z ',host,' app 1 - - ',props)"),
    "four_digit_fraction": (8, "concat('<',pri,'>',iso,'.',substr(us,1,4),'Z ',host,' app: ',props)"),
    "no_space_after_date": (8, "concat('<',pri,'>',iso,'Z')"),
    "thirteenth_month": (8, "concat('<',pri,'>2024-13-01T',hms,'Z ',host,' app: ',props)"),
    "late_february": (8, "concat('<',pri,'>Feb 30 ',hms,' ',host,' app: ',props)"),
    "hour_24": (8, "concat('<',pri,'>1 2024-01-01T24:00:00Z ',host,' app 1 - - ',props)"),
    "far_offset": (8, "concat('<',pri,'>1 ',iso,'+25:00 ',host,' app 1 - - ',props)"),
    "old_stamp_new_family": (8, "concat('<',pri,'>1 ',mon,' ',hms,' ',host,' app 1 - - ',props)"),
    "ends_at_host": (9, "concat('<',pri,'>1 ',iso,'Z ',host)"),
    "old_ends_at_host": (9, "concat('<',pri,'>',iso,'Z ',host)"),
    "ends_at_app": (10, "concat('<',pri,'>1 ',iso,'Z ',host,' ',event_type)"),
    "old_nothing_after_host": (10, "concat('<',pri,'>',iso,'Z ',host,' ')"),
    "ends_at_procid": (11, "concat('<',pri,'>1 ',iso,'Z ',host,' ',event_type,' ',event_id)"),
    "word_procid": (12, "concat('<',pri,'>1 ',iso,'Z ',host,' app ',event_type,' - - ',props)"),
    "empty_procid": (12, "concat('<',pri,'>1 ',iso,'Z ',host,' app  - - ',props)"),
    "ends_at_msgid": (13, "concat('<',pri,'>1 ',iso,'Z ',host,' app ',event_id,' ID')"),
    "open_bracket": (14, "concat('<',pri,'>',iso,'Z ',host,' app[',event_id,': ',event_type)"),
    "word_pid": (12, "concat('<',pri,'>',iso,'Z ',host,' app[',event_type,']: ',props)"),
    "empty_pid": (12, "concat('<',pri,'>',iso,'Z ',host,' app[]: ',props)"),
    "tag_only": (15, "concat('<',pri,'>',iso,'Z ',host,' ',event_type)"),
    "no_space_after_colon": (15, "concat('<',pri,'>',iso,'Z ',host,' ',event_type,':',event_id)"),
    "no_space_after_pid": (15, "concat('<',pri,'>',iso,'Z ',host,' app[',event_id,']',event_type)"),
    "wide_pid": (16, "concat('<',pri,'>',iso,'Z ',host,' app[99999999999]: ',props)"),
    "wide_priority": (16, "concat('<99999999999>',iso,'Z ',host,' app: ',props)"),
}

# Endings that make an escaped line malformed.
BAD_ESCAPES = {
    "open": "\\", "open_hex": "\\x", "half_hex": "\\x1", "bad_hex": "\\xzz", "unknown": "\\w",
}
