-- How much of each region's reimbursement lies inside the monthly statistic?
SELECT
    BEN_RES_REG AS region,
    count(*) FILTER (WHERE TOP_PS5_TRG = '1') AS rows_in_scope,
    count(*) AS all_rows,
    CAST(coalesce(sum(FLT_REM_MNT) FILTER (WHERE TOP_PS5_TRG = '1'), 0) AS DECIMAL(38, 6)) AS in_scope
FROM remboursements
GROUP BY BEN_RES_REG
ORDER BY region NULLS LAST
