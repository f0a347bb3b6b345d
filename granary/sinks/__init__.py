"""Writers: tables with partition rules, upserts, report files and documents."""
