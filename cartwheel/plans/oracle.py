"""The same queries as DuckDB SQL over the given tables.

``BLOCKS`` are named common table expressions; a query names the blocks it uses and ``_compose`` adds the blocks those
need in turn.  The text is written on its own, not generated from the Spark side.
"""

from __future__ import annotations

import re

AS_OF = "timestamp '2001-12-31'"
T1, T2 = "timestamp '1995-01-01'", "timestamp '1998-07-01'"
RANGE = "date '1997-01-15' and date '1999-03-20'"


def _avg(total: str, n: str) -> str:
    """total / n to two decimals, halves up, in whole numbers."""
    return (f"cast((cast({total} * 100 as hugeint) * 2 + cast({n} as hugeint)) // (2 * cast({n} as hugeint)) "
            "as decimal(38,0)) / 100")


def _money(expr: str) -> str:
    return f"cast({expr} as decimal(18,2))"


def _pct(part: str, whole: str) -> str:
    """part / whole in percent to one decimal, halves up (both non-negative)."""
    p, w = f"cast({part} as hugeint)", f"cast({whole} as hugeint)"
    return f"cast(case when {w} = 0 then 0 else (2000 * {p} + {w}) // (2 * {w}) end / 10 as decimal(18,1))"


def _pct_even(part: str, whole: str) -> str:
    p, w = f"cast({part} as hugeint)", f"cast({whole} as hugeint)"
    q, rest = f"(1000 * {p}) // {w}", f"(1000 * {p}) % {w}"
    up = f"case when 2 * ({rest}) > {w} or (2 * ({rest}) = {w} and ({q}) % 2 = 1) then 1 else 0 end"
    return f"cast(case when {w} = 0 then 0 else {q} + {up} end / 10 as decimal(18,1))"


BLOCKS = {
    "stg_customers": """
        select c_custkey as CustomerId, c_name as FullName, lower(replace(c_name, '#', '')) || '@example.com' as Email,
               case when c_custkey % 17 = 0 then null else n_name end as City
        from customer join nation on c_nationkey = n_nationkey""",
    "stg_products": """
        select p_partkey as ProductId, 'SKU-' || lpad(cast(p_partkey as varchar), 6, '0') as Sku, p_name as Name,
               p_type as Category, case when p_partkey % 13 = 0 then null else p_brand end as Brand,
               cast(p_retailprice as decimal(18,2)) as Price,
               cast((p_partkey * 37 + 11) % 200 as int) as StockQuantity
        from part""",
    "stg_orders0": """
        select o_orderkey as OrderId, 'ORD-' || lpad(cast(o_orderkey as varchar), 8, '0') as OrderNumber,
               o_custkey as CustomerId, o_orderdate as OrderDate,
               case when o_orderkey % 10 = 0 then 5 when o_orderstatus = 'F' then 4 when o_orderstatus = 'P' then 3
                    when o_orderkey % 2 = 0 then 2 else 1 end as Status,
               case when o_orderpriority in ('1-URGENT','2-HIGH') then 2 when o_orderpriority = '3-MEDIUM' then 3
                    else 1 end as PaymentMethod,
               cast(o_totalprice as decimal(18,2)) as TotalAmount
        from orders""",
    "stg_orders": """
        select o.*, case when PaymentMethod = 1 then case when Status = 4 then 3 else 1 end
                         when Status = 5 then 5 when Status >= 2 then 3 when OrderId % 4 = 1 then 2
                         when OrderId % 4 = 3 and OrderId % 3 = 0 then 4 else 3 end as PaymentStatus
        from stg_orders0 o""",
    "stg_items": """
        select (l_orderkey * 10 + l_linenumber) * 1000003
               + row_number() over (partition by l_orderkey, l_linenumber
                                    order by l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice)
                 as OrderItemId,
               l_orderkey as OrderId, l_partkey as ProductId, cast(l_quantity as int) as Quantity,
               cast(floor(l_extendedprice * 100 / l_quantity) / 100 as decimal(18,2)) as UnitPrice,
               cast(l_extendedprice as decimal(18,2)) as LineTotal
        from lineitem""",
    "loads": """
        select OrderId, CustomerId, OrderDate,
               case when OrderId * 2 < (select max(o_orderkey) from orders) then 1 else 2 end as LoadNr
        from stg_orders""",
    "cust1": """
        select *, sha256(FullName || '|' || Email || '|' || coalesce(City, '')) as RowHash
        from stg_customers where CustomerId % 50 <> 0""",
    "cust2": """
        select *, sha256(FullName || '|' || Email || '|' || coalesce(City, '')) as RowHash
        from (select CustomerId, FullName, Email, case when CustomerId % 8 = 0 then 'MOVED' else City end as City
              from stg_customers)""",
    "prod1": """
        select *, sha256(Sku || '|' || Name || '|' || Category || '|' || coalesce(Brand, '')) as RowHash
        from stg_products""",
    "prod2": """
        select *, sha256(Sku || '|' || Name || '|' || Category || '|' || coalesce(Brand, '')) as RowHash
        from (select ProductId, Sku, case when ProductId % 10 = 0 then Name || ' II' else Name end as Name, Category,
                     Brand from stg_products)""",
    "dim_customer": f"""
        select a.CustomerId * 1000 + 1 as CustomerKey, a.CustomerId, a.FullName, a.Email, a.City, {T1} as ValidFrom,
               case when a.RowHash <> b.RowHash then {T2} end as ValidTo,
               coalesce(a.RowHash = b.RowHash, true) as IsCurrent, 1 as Version, a.RowHash
        from cust1 a left join cust2 b using (CustomerId)
        union all
        select b.CustomerId * 1000 + case when a.CustomerId is null then 1 else 2 end, b.CustomerId, b.FullName,
               b.Email, b.City, {T2}, null, true, case when a.CustomerId is null then 1 else 2 end, b.RowHash
        from cust2 b left join cust1 a using (CustomerId)
        where a.RowHash is null or a.RowHash <> b.RowHash""",
    "dim_product": f"""
        select a.ProductId * 1000 + 1 as ProductKey, a.ProductId, a.Sku, a.Name, a.Category, a.Brand,
               {T1} as ValidFrom, case when a.RowHash <> b.RowHash then {T2} end as ValidTo,
               coalesce(a.RowHash = b.RowHash, true) as IsCurrent, 1 as Version, a.RowHash
        from prod1 a left join prod2 b using (ProductId)
        union all
        select b.ProductId * 1000 + 2, b.ProductId, b.Sku, b.Name, b.Category, b.Brand, {T2}, null, true, 2, b.RowHash
        from prod2 b join prod1 a using (ProductId) where a.RowHash <> b.RowHash""",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as int) as DateKey, d as Date, cast(year(d) as int) as Year,
               cast(quarter(d) as int) as Quarter, cast(month(d) as int) as Month, strftime(d, '%B') as MonthName,
               cast(day(d) as int) as Day, cast(dayofweek(d) + 1 as int) as DayOfWeek,
               dayofweek(d) in (0, 6) as IsWeekend
        from (select cast(unnest(generate_series((select cast(min(o_orderdate) as date) from orders)::timestamp,
                     (select cast(max(o_orderdate) as date) from orders)::timestamp, interval 1 day)) as date) as d)""",
    "resolved": """
        select cast(strftime(o.OrderDate, '%Y%m%d') as int) as DateKey, o.LoadNr, i.*, o.CustomerId,
               c.CustomerKey, p.ProductKey
        from stg_items i join loads o using (OrderId)
        left join (select 1 as LoadNr, CustomerId, CustomerId * 1000 + 1 as CustomerKey from cust1
                   union all select 2, CustomerId, CustomerKey from dim_customer where IsCurrent) c
               on c.LoadNr = o.LoadNr and c.CustomerId = o.CustomerId
        left join (select 1 as LoadNr, ProductId, ProductId * 1000 + 1 as ProductKey from prod1
                   union all select 2, ProductId, ProductKey from dim_product where IsCurrent) p
               on p.LoadNr = o.LoadNr and p.ProductId = i.ProductId""",
    "fact": """
        select DateKey, CustomerKey, ProductKey, OrderId, OrderItemId, Quantity, UnitPrice, LineTotal
        from resolved where CustomerKey is not null and ProductKey is not null""",
    "daily": f"""
        select d.Date, p.Category, count(distinct f.OrderId) as OrderCount, count(*) as ItemCount,
               sum(f.LineTotal) as TotalRevenue,
               {_money(_avg('sum(f.LineTotal)', 'count(distinct f.OrderId)'))} as AvgOrderValue
        from fact f join dim_date d using (DateKey) join dim_product p using (ProductKey)
        group by d.Date, p.Category""",
    "monthly": """
        select * from (
            select d.Year, d.Month, p.ProductId, p.Sku, p.Name as ProductName, p.Category,
                   cast(sum(f.Quantity) as bigint) as TotalQuantity, sum(f.LineTotal) as TotalRevenue,
                   row_number() over (partition by d.Year, d.Month
                                      order by sum(f.LineTotal) desc, p.ProductId, p.Name) as RankInMonth
            from fact f join dim_date d using (DateKey) join dim_product p using (ProductKey)
            group by d.Year, d.Month, p.ProductId, p.Sku, p.Name, p.Category) where RankInMonth <= 50""",
    "clv": f"""
        select c.CustomerId, min(d.Date) as FirstOrderDate, max(d.Date) as LastOrderDate,
               count(distinct f.OrderId) as TotalOrders, sum(f.LineTotal) as TotalRevenue,
               {_money(_avg('sum(f.LineTotal)', 'count(distinct f.OrderId)'))} as AvgOrderValue,
               datediff('day', max(d.Date), date '2001-12-31') as DaysSinceLastOrder
        from fact f join dim_customer c using (CustomerKey) join dim_date d using (DateKey) group by c.CustomerId""",
    "mix": """
        select PaymentMethod, case PaymentMethod when 1 then 'COD' when 2 then 'VNPay' else 'MoMo' end as MethodName,
               count(*) as OrderCount, count(*) filter (PaymentStatus = 3) as PaidOrderCount,
               sum(TotalAmount) as TotalRevenue,
               sum(case when PaymentStatus = 3 then TotalAmount else 0 end) as PaidRevenue
        from stg_orders group by PaymentMethod""",
    "funnel": """
        select 'Placed' as Stage, 1 as StageOrder, count(*) as OrderCount from stg_orders
        union all select 'Paid', 2, count(*) from stg_orders where PaymentStatus = 3
        union all select 'Confirmed', 3, count(*) from stg_orders where Status in (2, 3, 4)
        union all select 'Shipped', 4, count(*) from stg_orders where Status in (3, 4)
        union all select 'Delivered', 5, count(*) from stg_orders where Status = 4
        union all select 'Cancelled', 6, count(*) from stg_orders where Status = 5""",
    "inventory": """
        select s.ProductId, s.Sku, s.Name as ProductName, s.Category, s.StockQuantity as CurrentStock,
               coalesce(u.Units, 0) as UnitsSold, s.StockQuantity < 20 as LowStock
        from stg_products s left join (
            select p.ProductId, cast(sum(f.Quantity) as bigint) as Units
            from fact f join dim_product p on p.ProductKey = f.ProductKey and p.IsCurrent group by p.ProductId) u
        using (ProductId)""",
    "inventory_all": """
        select s.ProductId, s.Sku, s.Name as ProductName, s.Category, s.StockQuantity as CurrentStock,
               coalesce(u.Units, 0) as UnitsSold, s.StockQuantity < 20 as LowStock
        from stg_products s left join (
            select p.ProductId, cast(sum(f.Quantity) as bigint) as Units
            from fact f join dim_product p using (ProductKey) group by p.ProductId) u using (ProductId)""",
    "by_category": f"""
        select Category, cast(sum(OrderCount) as bigint) as OrderCount, sum(TotalRevenue) as TotalRevenue
        from daily where Date between {RANGE} group by Category""",
    "by_day": f"""
        select Date as Day, cast(sum(OrderCount) as bigint) as OrderCount, sum(TotalRevenue) as TotalRevenue
        from daily where Date between {RANGE} group by Date""",
    # ---- quality fixture
    "bad_fact": f"""
        select case when OrderItemId % 127 = 0 then 19000101 else DateKey end as DateKey,
               case when OrderItemId % 109 = 0 then -1 else CustomerKey end as CustomerKey,
               case when OrderItemId % 113 = 0 then -1 else ProductKey end as ProductKey, OrderId, OrderItemId,
               case when OrderItemId % 101 = 0 then 0 else Quantity end as Quantity, UnitPrice,
               case when OrderItemId % 103 = 0 then -1 else LineTotal end as LineTotal,
               {AS_OF} - interval 3 day as EtlLoadedAt
        from fact join (values (1), (2)) v(copy) on copy = 1 or OrderItemId % 107 = 0""",
    "bad_customer": """
        select CustomerKey, CustomerId, IsCurrent from dim_customer
        union all select CustomerKey + 500, CustomerId, IsCurrent from dim_customer
        where CustomerId % 400 = 0 and IsCurrent""",
    "dq_numbers": f"""
        select 'fact_no_duplicate_orderitemid' as TestName, 'Uniqueness' as Category, 'Critical' as Severity,
               '0 duplicate OrderItemIds in fact' as ExpectedValue, 'zero' as Rule,
               (select count(*) from (select 1 from bad_fact group by OrderItemId having count(*) > 1)) as n
        union all select 'dim_customer_one_current_per_id', 'Uniqueness', 'Critical',
               '0 customers with >1 IsCurrent=1 row', 'zero',
               (select count(*) from (select 1 from bad_customer where IsCurrent group by CustomerId
                                      having count(*) > 1))
        union all select 'fact_customerkey_resolves', 'Integrity', 'Critical',
               '0 fact rows with orphan CustomerKey', 'zero',
               (select count(*) from bad_fact f where not exists
                (select 1 from bad_customer c where c.CustomerKey = f.CustomerKey))
        union all select 'fact_productkey_resolves', 'Integrity', 'Critical',
               '0 fact rows with orphan ProductKey', 'zero',
               (select count(*) from bad_fact f where not exists
                (select 1 from dim_product p where p.ProductKey = f.ProductKey))
        union all select 'fact_datekey_resolves', 'Integrity', 'Critical', '0 fact rows with orphan DateKey', 'zero',
               (select count(*) from bad_fact f where not exists
                (select 1 from dim_date d where d.DateKey = f.DateKey))
        union all select 'fact_freshness_24h', 'Freshness', 'Warning', 'ETL loaded fact in last 24h', 'positive',
               (select case when max(EtlLoadedAt) > {AS_OF} - interval 24 hour then 1 else 0 end from bad_fact)
        union all select 'gold_freshness_2h', 'Freshness', 'Warning', 'Gold layer refreshed in last 2h', 'positive',
               (select case when max({AS_OF} - interval 3 hour) > {AS_OF} - interval 2 hour then 1 else 0 end
                from daily)
        union all select 'fact_row_count_nonzero', 'Completeness', 'Critical', '>0 rows in fact (sanity)',
               'positive', (select count(*) from bad_fact)
        union all select 'dim_customer_count_nonzero', 'Completeness', 'Critical', '>0 customers in dim', 'positive',
               (select count(*) from bad_customer where IsCurrent)
        union all select 'fact_no_negative_revenue', 'Business', 'Critical', '0 fact rows with LineTotal <= 0',
               'zero', (select count(*) from bad_fact where LineTotal <= 0)
        union all select 'fact_no_zero_quantity', 'Business', 'Critical', '0 fact rows with Quantity <= 0', 'zero',
               (select count(*) from bad_fact where Quantity <= 0)
        union all select 'fact_unitprice_lineTotal_consistency', 'Business', 'Warning',
               '0 fact rows where Quantity*UnitPrice ≠ LineTotal (rounded)', 'zero',
               (select count(*) from bad_fact where abs(Quantity * UnitPrice - LineTotal) > 0.01)
        union all select 'inventory_no_negative_stock', 'Business', 'Critical',
               '0 products with CurrentStock < 0 (oversell guard)', 'zero',
               (select count(*) from stg_products where ProductId % 500 = 0)
        union all select 'inventory_low_stock_watch', 'Business', 'Warning',
               '0 products below the low-stock threshold (informational)', 'zero',
               (select count(*) from stg_products where StockQuantity < 20 or ProductId % 500 = 0)
        union all select 'payment_paid_not_exceed_total', 'Business', 'Critical',
               '0 payment methods where PaidRevenue > TotalRevenue', 'zero',
               (select count(*) from mix where case when PaymentMethod = 3 then TotalRevenue + 1 else PaidRevenue end
                                               > TotalRevenue)""",
    "dq": f"""
        select TestName, Category, Severity,
               case when (Rule = 'zero' and n = 0) or (Rule = 'positive' and n > 0) then 'Pass' else 'Fail' end
                 as Status,
               cast(n as varchar) as ActualValue, ExpectedValue, cast(null as varchar) as Message, {AS_OF} as RunAt
        from dq_numbers""",
    # ---- watermark
    "wm_first": """
        select max(OrderItemId) as id from stg_items join loads using (OrderId) where LoadNr = 1""",
    "wm": f"""
        select 'SalesOrderItem' as PipelineName, max(OrderItemId) as LastProcessedRowId, {T2} as LastProcessedAt
        from stg_items
        union all select 'Orders', max(OrderId), {T1} from stg_orders""",
    # ---- requests, events, payments
    "requests": """
        select l_orderkey as OrderId, case when l_orderkey % 499 = 0 and l_linenumber = 1 then -l_partkey - 1
                                           else l_partkey end as ProductId, cast(l_quantity as int) as Quantity
        from lineitem""",
    "demand": """
        select OrderId, ProductId, cast(sum(Quantity) as bigint) as Quantity from requests group by OrderId, ProductId""",
    "owner_requests": """
        select OrderId as RequestId, case when OrderId % 31 = 0 then -OrderId - 1 else OrderId end as OrderId,
               case when OrderId % 6 = 0 then CustomerId + 1 else CustomerId end as RequesterId
        from stg_orders""",
    "order_events": """
        select OrderId * 10 + Step as EventId, OrderId, CustomerId as ActorCustomerId,
               case when Step = 0 then null when Reached = 5 then 1 else Reached - 1 end as FromStatus,
               case when Step = Steps - 1 and OrderId % 50 = 0 then case when Step = 0 then 3 else Reached - 1 end
                    else Reached end as ToStatus,
               OrderDate + to_hours(Step) as CreatedAt
        from (select OrderId, CustomerId, OrderDate, cast(s as int) as Step,
                     case when Status = 5 then 2 else Status end as Steps,
                     cast(case when Status = 5 then case when s = 0 then 1 else 5 end else s + 1 end as int) as Reached
              from stg_orders, (select unnest(range(4)) as s) where s < case when Status = 5 then 2 else Status end)""",
    "payments": """
        select OrderId, OrderNumber, PaymentMethod as Provider, TotalAmount as Amount,
               'REF' || cast(OrderId as varchar) as Ref, Status as OrderStatus
        from stg_orders where PaymentMethod in (2, 3)""",
    "callbacks": """
        select i.OrderItemId as Seq, p.Provider,
               case when i.OrderItemId % 11 = 0 then 'LOST' || cast(i.OrderItemId as varchar) else p.Ref end as Ref,
               cast(case when i.OrderItemId % 6 = 0 then p.Amount - 1 else p.Amount end as decimal(18,2)) as Amount,
               i.OrderItemId % 7 <> 0 as SignatureValid,
               i.OrderItemId % 7 <> 0 and i.OrderItemId % 5 <> 0 as Success
        from stg_items i join payments p using (OrderId)""",
    "settled": """
        select c.Seq, c.Ref, p.OrderId, p.OrderNumber,
               case when p.OrderId is null then 'Unknown payment reference.'
                    when c.PaidBefore then 'Already processed.'
                    when not c.SignatureValid then 'Invalid signature.'
                    when c.Success and c.Amount <> p.Amount then 'Amount mismatch.'
                    when c.Success then 'Payment successful.' else 'Payment failed or cancelled.' end as Outcome,
               c.FailedBefore, p.OrderStatus
        from (select k.*, coalesce(bool_or(k.Good) over w, false) as PaidBefore,
                     coalesce(bool_or(k.SignatureValid and not k.Good) over w, false) as FailedBefore
              from (select c.*, coalesce(c.Success and c.Amount = q.Amount, false) as Good
                    from callbacks c left join payments q using (Ref)) k
              window w as (partition by k.Ref order by k.Seq rows between unbounded preceding and 1 preceding)) c
        left join payments p using (Ref)""",
    "settlement": """
        select Seq, Ref, OrderId, OrderNumber, Outcome in ('Already processed.', 'Payment successful.') as Ok,
               case when Outcome in ('Already processed.', 'Payment successful.') then 3
                    when Outcome = 'Invalid signature.' then case when FailedBefore then 4 else 2 end
                    else 4 end as PaymentStatus, Outcome,
               Outcome = 'Payment successful.' and coalesce(OrderStatus = 1, false) as AutoConfirms,
               Outcome = 'Payment successful.' as Notifies
        from settled""",
    # ---- outbox
    "outbox": """
        select OrderId as OutboxId, case when OrderId % 97 = 0 then -OrderId - 1 else OrderId end as OrderId,
               case when OrderId % 3 = 0 then 'OrderPlaced' when OrderId % 3 = 1 then 'PaymentSucceeded'
                    when OrderId % 2 = 0 then 'OrderStatusChanged' else 'Other' end as EventType,
               '{"from":1,"to":' || cast(Status as varchar) || '}' as Payload,
               case when OrderId % 4 = 0 then OrderDate end as ProcessedAt, cast(OrderId % 7 as int) as Attempts,
               cast(null as varchar) as LastError
        from stg_orders""",
    "due": "select * from outbox where ProcessedAt is null and Attempts < 5",
    "tries": """
        select OrderId as OutboxId, case when OrderId % 9 = 0 then 9 when OrderId % 5 = 0 then 2 else 0 end as Failures
        from stg_orders""",
    # ---- feeds
    "cust_feed": """
        select CustomerId + 2 as RowNo, case when CustomerId % 11 = 0 then '' else FullName end as FullName,
               case when CustomerId % 13 = 0 then ''
                    when CustomerId % 7 = 0 then 'CUSTOMER' || lpad(cast(CustomerId - CustomerId % 3 as varchar), 9, '0')
                                                 || '@EXAMPLE.COM' else Email end as Email,
               case when CustomerId % 4 = 0 then '' else '0901234567' end as Phone, coalesce(City, '') as City
        from stg_customers""",
    "known_emails": """
        select case when CustomerId % 9 = 0 then Email else 'old' || cast(CustomerId as varchar) || '@example.com' end
               as Email from stg_customers""",
    "cust_checked": """
        select f.*, case when FullName = '' then 'FullName is required' when Email = '' then 'Email is required'
                         when lower(Email) in (select lower(Email) from known_emails)
                              or row_number() over (partition by lower(Email), FullName = '' or Email = ''
                                                    order by RowNo) > 1 then 'Duplicate Email: ' || Email end as Error
        from cust_feed f""",
    "prod_feed": """
        select ProductId + 2 as RowNo,
               case when ProductId % 31 = 0 then ''
                    when ProductId % 6 = 0 then 'sku-' || lpad(cast(ProductId - ProductId % 4 as varchar), 6, '0')
                    else Sku end as Sku,
               case when ProductId % 37 = 0 then '' else Name end as Name,
               case when ProductId % 41 = 0 then '' else Category end as Category, coalesce(Brand, '') as Brand,
               case when ProductId % 43 = 0 then '0' when ProductId % 47 = 0 then 'abc'
                    else cast(Price as varchar) end as Price,
               case when ProductId % 53 = 0 then 'many' else cast(StockQuantity as varchar) end as StockQuantity
        from stg_products""",
    "known_skus": """
        select case when ProductId % 15 = 0 then Sku else 'OLD-' || cast(ProductId as varchar) end as Sku
        from stg_products""",
    "prod_checked0": """
        select f.*, try_cast(Price as decimal(18,2)) as P, try_cast(StockQuantity as int) as Q,
               case when try_cast(Price as decimal(18,2)) is null then 'Price is not a number'
                    when try_cast(StockQuantity as int) is null then 'StockQuantity is not a number'
                    when Sku = '' then 'Sku is required' when Name = '' then 'Name is required'
                    when Category = '' then 'Category is required'
                    when try_cast(Price as decimal(18,2)) <= 0 then 'Price must be > 0' end as Early
        from prod_feed f""",
    "prod_checked": """
        select *, coalesce(Early, case when lower(Sku) in (select lower(Sku) from known_skus)
                                         or row_number() over (partition by lower(Sku), Early is null order by RowNo) > 1
                                       then 'Duplicate Sku: ' || Sku end) as Error
        from prod_checked0""",
    "order_feed": """
        select i.OrderItemId + 2 as RowNo,
               case when i.OrderItemId % 41 = 0 then '' else 'R' || cast(i.OrderId as varchar) end as OrderRef,
               case when i.OrderItemId % 43 = 0 then '' when i.OrderId % 29 = 0 then 'ghost' || c.Email
                    when i.OrderItemId % 3 = 0 then upper(c.Email) else c.Email end as CustomerEmail,
               case when i.OrderItemId % 47 = 0 then '' when i.OrderItemId % 211 = 0 then 'sku-none'
                    when i.OrderItemId % 2 = 0 then 'sku-' || lpad(cast(i.ProductId as varchar), 6, '0')
                    else 'SKU-' || lpad(cast(i.ProductId as varchar), 6, '0') end as Sku,
               case when i.OrderItemId % 53 = 0 then '0' when i.OrderItemId % 59 = 0 then 'x'
                    else cast(i.Quantity as varchar) end as Quantity
        from stg_items i join stg_orders o using (OrderId) join stg_customers c using (CustomerId)""",
    "order_checked": """
        select f.*, try_cast(Quantity as int) as Q,
               case when try_cast(Quantity as int) is null then 'Quantity is not a number'
                    when OrderRef = '' then 'OrderRef is required'
                    when CustomerEmail = '' then 'CustomerEmail is required' when Sku = '' then 'Sku is required'
                    when try_cast(Quantity as int) <= 0 then 'Quantity must be > 0' end as Error
        from order_feed f""",
    "order_lines": """
        select f.*, p.ProductId, cast(p.Price * f.Q as decimal(18,2)) as LineTotal,
               first_value(f.CustomerEmail) over (partition by f.OrderRef order by f.RowNo) as FirstEmail,
               min(f.RowNo) over (partition by f.OrderRef) as FirstRow
        from order_checked f left join stg_products p on lower(p.Sku) = lower(f.Sku) where f.Error is null""",
    "order_refs": """
        select l.OrderRef, min(l.FirstRow) as FirstRow, min(l.FirstEmail) as Email, min(c.CustomerId) as CustomerId,
               count(*) filter (l.ProductId is null) as Unknown, count(*) as Lines, sum(l.LineTotal) as TotalAmount
        from order_lines l left join stg_customers c on lower(c.Email) = lower(l.FirstEmail) group by l.OrderRef""",
    "order_errors": """
        select RowNo, Error as Message from order_checked where Error is not null
        union all select FirstRow, 'Customer not found by email: ' || Email from order_refs where CustomerId is null
        union all select l.RowNo, 'Product not found by SKU: ' || l.Sku from order_lines l join order_refs r
            using (OrderRef) where l.ProductId is null and r.CustomerId is not null""",
    "order_accepted": """
        select OrderRef, CustomerId, Lines, TotalAmount from order_refs where CustomerId is not null and Unknown = 0""",
    # ---- logs
    "ask_log": """
        select event_id as AskId, ts as AskedAt, props as Question,
               case when event_type in ('click', 'purchase') then 'Answered' when event_type = 'signup' then 'Refused'
                    when event_type = 'error' then 'Error' else 'CacheHit' end as Status,
               cast(cast(value as decimal(18,2)) * 100 as bigint) as LatencyMs
        from events""",
    "evals": r"""
        select case k when 0 then 'easy' when 1 then 'easy' when 2 then 'medium' else 'hard' end as Difficulty,
               k < 3 as Passed, LatencyMs
        from (select cast(regexp_extract(props, '\d+') as int) % 5 as k,
                     cast(cast(value as decimal(18,2)) * 100 as bigint) as LatencyMs from events) where k < 4""",
    # ---- sales star over the given tables
    "fnb_product": """
        select p_partkey as ProductKey, p_name as ProductName from part""",
    "fnb_store": """
        select s_suppkey as StoreKey, s_name as StoreName, n_name as City
        from supplier left join nation on s_nationkey = n_nationkey""",
    "fnb_customer": """
        select c_custkey as CustomerKey, c_name as CustomerName,
               case when c_acctbal >= 7500 then 'Gold' when c_acctbal >= 2500 then 'Silver' else 'Bronze' end
                 as MembershipTier, n_name as City
        from customer left join nation on c_nationkey = n_nationkey""",
    "fnb_fact": """
        select OrderId, l_linenumber as LineNumber, l_suppkey as StoreKey, l_partkey as ProductKey,
               cast(l_quantity as int) as Quantity, gross as GrossAmount, disc as DiscountAmount,
               cast(gross - disc as decimal(18,2)) as LineTotal, CustomerId as CustomerKey,
               cast(strftime(d, '%Y%m%d') as int) as DateKey,
               case PaymentMethod when 1 then 'Cash' when 2 then 'Card' when 3 then 'EWallet' end as PaymentMethod, d
        from (select *, cast(round(gross * cast(l_discount as decimal(4,2)), 2) as decimal(18,2)) as disc,
                     cast(OrderDate + interval 24 year as date) as d
              from (select *, cast(l_extendedprice as decimal(18,2)) as gross from lineitem) l
              join stg_orders o on o.OrderId = l.l_orderkey)""",
}

_DQ = {
    "dq_fact_duplicates": "fact_no_duplicate_orderitemid",
    "dq_one_current_customer": "dim_customer_one_current_per_id",
    "dq_orphan_customer": "fact_customerkey_resolves", "dq_orphan_product": "fact_productkey_resolves",
    "dq_orphan_date": "fact_datekey_resolves", "dq_fact_freshness": "fact_freshness_24h",
    "dq_gold_freshness": "gold_freshness_2h", "dq_fact_nonempty": "fact_row_count_nonzero",
    "dq_customer_nonempty": "dim_customer_count_nonzero", "dq_negative_revenue": "fact_no_negative_revenue",
    "dq_zero_quantity": "fact_no_zero_quantity", "dq_line_consistency": "fact_unitprice_lineTotal_consistency",
    "dq_negative_stock": "inventory_no_negative_stock", "dq_low_stock": "inventory_low_stock_watch",
    "dq_paid_le_total": "payment_paid_not_exceed_total",
}

_MATCHING = """from stg_orders o join stg_customers c using (CustomerId)
    where o.Status = 4 and o.OrderDate >= timestamp '1996-01-01' and o.OrderDate <= timestamp '2000-12-31'
      and (lower(o.OrderNumber) like '%customer#0000000%' or lower(c.FullName) like '%customer#0000000%')"""
_CODE5 = "case when Seq % 5 = 0 then '24' else '00' end"


def _enc(text: str) -> str:
    return f"replace(url_encode({text}), '%20', '+')"


def _page_html(heading: str, body: str) -> str:
    return ("'<div style=\"font-family:Arial,sans-serif;max-width:560px;margin:auto;color:#1f2937\">' || chr(10) "
            f"|| '  <h2 style=\"color:#2563eb\">{heading}</h2>' || chr(10) "
            f"|| '  <p style=\"font-size:15px;line-height:1.6\">' || {body} || '</p>' || chr(10) "
            "|| '  <hr style=\"border:none;border-top:1px solid #e5e7eb;margin:24px 0\"/>' || chr(10) "
            "|| '  <p style=\"font-size:12px;color:#9ca3af\">Shop — email tự động, vui lòng không trả lời.</p>' "
            "|| chr(10) || '</div>'")


def _dots(amount: str) -> str:
    """Whole units grouped by dots."""
    digits = f"cast(cast(round({amount}, 0) as decimal(38,0)) as varchar)"
    return f"replace(format('{{:,}}', cast({digits} as bigint)), ',', '.')"


def _compact(amount: str, suffix: str) -> str:
    def scaled(unit: str, letter: str) -> str:
        # one decimal, halves up, in whole numbers of hundredths
        tenths = f"(cast({amount} * 100 as hugeint) * 20 + {unit}00) // ({unit}00 * 2)"
        return f"cast(({tenths}) // 10 as varchar) || '.' || cast(({tenths}) % 10 as varchar) || '{letter}{suffix}'"

    plain = f"replace(regexp_replace(cast(cast({amount} as decimal(18,2)) as varchar), '\\.?0+$', ''), '.', ',')"
    return (f"case when {amount} >= 1000000000000 then {scaled('1000000000000', 'T')} "
            f"when {amount} >= 1000000000 then {scaled('1000000000', 'B')} "
            f"when {amount} >= 1000000 then {scaled('1000000', 'M')} "
            f"when {amount} >= 1000 then {scaled('1000', 'K')} else {plain} || '{suffix}' end")


QUERIES = {
    # ---- ingest
    "incremental_extract": """
        select OrderItemId, OrderId, CustomerId, ProductId, OrderDate, Quantity, UnitPrice, LineTotal
        from stg_items join stg_orders using (OrderId) where OrderItemId > (select id from wm_first)""",
    "watermark_advance": "select * from wm",
    "bronze_dedup": """
        select LineKey, OrderId, ProductId, SupplierId, Quantity, LineTotal from (
            select l_orderkey * 8 + l_linenumber as LineKey, l_orderkey as OrderId, l_partkey as ProductId,
                   l_suppkey as SupplierId, cast(l_quantity as int) as Quantity,
                   cast(l_extendedprice as decimal(18,2)) as LineTotal,
                   row_number() over (partition by l_orderkey, l_linenumber
                       order by l_partkey, l_suppkey, cast(l_quantity as int), cast(l_extendedprice as decimal(18,2)))
                     as rn
            from lineitem) where rn = 1 and OrderId % 2 <> 0""",
    "silver_fact": "select * from fact",
    "fact_quarantine": """
        select OrderItemId, OrderId, CustomerId, ProductId, DateKey, Quantity, LineTotal,
               case when CustomerKey is null then 'unknown customer' else 'unknown product' end as Reason
        from resolved where CustomerKey is null or ProductKey is null""",
    "stg_orders_payment": "select OrderId, Status, PaymentMethod, PaymentStatus from stg_orders",
    "fnb_dim_customer": "select * from fnb_customer",
    "fnb_dim_date": """
        select DateKey, Date, Year, Quarter, Month, MonthName, Day, cast(isodow(Date) as int) as DayOfWeek,
               strftime(Date, '%A') as DayName, isodow(Date) in (6, 7) as IsWeekend from dim_date""",
    "fnb_fact": "select * exclude (d) from fnb_fact",
    # ---- dimensions
    "scd2_customer": "select * from dim_customer",
    "scd2_product": "select * from dim_product",
    "dim_date": "select * from dim_date",
    "row_hash": """
        select CustomerId, sha256(FullName || '|' || Email || '|' || coalesce(City, '')) as RowHash
        from stg_customers""",
    "fact_asof_dims": """
        select i.OrderItemId, i.OrderId, c.CustomerKey as CustomerKeyAsOf, p.ProductKey as ProductKeyAsOf
        from stg_items i join stg_orders o using (OrderId)
        left join dim_customer c on c.CustomerId = o.CustomerId and o.OrderDate >= c.ValidFrom
             and (c.ValidTo is null or o.OrderDate < c.ValidTo)
        left join dim_product p on p.ProductId = i.ProductId and o.OrderDate >= p.ValidFrom
             and (p.ValidTo is null or o.OrderDate < p.ValidTo)""",
    "scd2_history": """
        select 'customer' as Dimension, CustomerId as NaturalId, Version, ValidFrom, ValidTo, IsCurrent,
               case when lag(Version) over w is null then '(new)' else concat_ws(',',
                    case when FullName is distinct from lag(FullName) over w then 'FullName' end,
                    case when Email is distinct from lag(Email) over w then 'Email' end,
                    case when City is distinct from lag(City) over w then 'City' end) end as Changed
        from dim_customer window w as (partition by CustomerId order by Version)
        union all
        select 'product', ProductId, Version, ValidFrom, ValidTo, IsCurrent,
               case when lag(Version) over w is null then '(new)' else concat_ws(',',
                    case when Sku is distinct from lag(Sku) over w then 'Sku' end,
                    case when Name is distinct from lag(Name) over w then 'Name' end,
                    case when Category is distinct from lag(Category) over w then 'Category' end,
                    case when Brand is distinct from lag(Brand) over w then 'Brand' end) end
        from dim_product window w as (partition by ProductId order by Version)""",
    # ---- gold
    "gold_daily_sales_by_category": "select * from daily",
    "gold_monthly_top_products": "select * from monthly",
    "gold_customer_lifetime_value": "select * from clv",
    "gold_sales_by_payment_method": "select * from mix",
    "gold_order_funnel": "select * from funnel",
    "gold_product_inventory": "select * from inventory",
    "gold_product_inventory_all_versions": "select * from inventory_all",
    "gold_daily_incremental": "select * from daily",
    "gold_monthly_incremental": "select * from monthly",
    "gold_clv_incremental": "select * from clv",
    "gold_inventory_from_parts": "select * from inventory",
    "gold_order_mix": """
        select Date, Categories, count(*) as OrderCount
        from (select d.Date, f.OrderId, string_agg(distinct p.Category, '|' order by p.Category) as Categories
              from fact f join dim_date d using (DateKey) join dim_product p using (ProductKey)
              group by d.Date, f.OrderId)
        group by Date, Categories""",
    # ---- reports
    "report_sales_by_category": "select * from by_category",
    "report_sales_by_day": "select * from by_day",
    "report_top_products": """
        select ProductId, max(Sku) as Sku, max(ProductName) as Name, cast(sum(TotalQuantity) as bigint)
               as TotalQuantity, sum(TotalRevenue) as TotalRevenue
        from monthly where make_date(Year, Month, 1) between date '1997-01-01' and date '1999-03-01'
        group by ProductId order by sum(TotalRevenue) desc, ProductId limit 10""",
    "report_top_products_exact": """
        select p.ProductId, max(p.Sku) as Sku, max(p.Name) as Name, cast(sum(f.Quantity) as bigint) as TotalQuantity,
               sum(f.LineTotal) as TotalRevenue
        from fact f join dim_product p using (ProductKey) where f.DateKey between 19970101 and 19990331
        group by p.ProductId order by sum(f.LineTotal) desc, p.ProductId limit 10""",
    "report_payment_mix": "select * from mix",
    "report_order_funnel": "select * from funnel",
    "report_low_stock": "select * from inventory where LowStock order by CurrentStock, ProductId limit 50",
    "kpi_tiles": """
        select sum(TotalRevenue) as TotalRevenue, cast(sum(OrderCount) as bigint) as TotalOrders,
               count(*) as ActiveCategories from by_category""",
    "kpi_exact_orders": """
        select count(distinct OrderId) as OrderCount from fact where DateKey between 19970115 and 19990320""",
    "kpi_orders_by_set": """
        with rows as (select f.OrderId, p.Category from fact f join dim_product p using (ProductKey)
                      where f.DateKey between 19970115 and 19990320)
        select '' as Categories, count(distinct OrderId) as OrderCount from rows
        union all select 'ECONOMY', count(distinct OrderId) from rows where Category = 'ECONOMY'
        union all select 'ECONOMY|PROMO', count(distinct OrderId) from rows where Category in ('ECONOMY', 'PROMO')""",
    "chart_sales_by_day": """
        select Day, cast((cast(TotalRevenue * 100 as hugeint) + 50000000) // 100000000 as bigint) as RevenueMillions,
               OrderCount as Orders from by_day""",
    "silver_sales_by_category": """
        select p.Category, count(*) as ItemCount, sum(f.LineTotal) as TotalRevenue
        from fact f join dim_product p using (ProductKey) where f.DateKey between 19970115 and 19990320
        group by p.Category""",
    "oltp_sales_by_category_90d": """
        select p.Category, count(*) as ItemCount, sum(i.LineTotal) as TotalRevenue
        from stg_items i join stg_orders o using (OrderId) join stg_products p using (ProductId)
        where o.OrderDate >= date '2001-08-01' - interval 90 day and o.OrderDate < timestamp '2001-08-02'
        group by p.Category""",
    "revenue_share": f"""
        select Category, TotalRevenue,
               {_pct('TotalRevenue * 100', '(select sum(TotalRevenue) * 100 from by_category)')} as SharePct
        from by_category""",
    "payment_paid_ratio": f"""
        select MethodName, cast(PaidOrderCount as varchar) || '/' || cast(OrderCount as varchar) as PaidLabel,
               {_pct('PaidOrderCount', 'OrderCount')} as PaidPct from mix""",
    # ---- quality
    **{key: f"select * from dq where TestName = '{name}'" for key, name in _DQ.items()},
    "dq_suite": "select * from dq",
    "dq_summary": """
        select count(*) as Total, count(*) filter (Status = 'Fail') as Failed,
               count(*) filter (Status = 'Fail' and Severity = 'Critical') as Critical,
               count(*) filter (Status = 'Fail' and Severity = 'Critical') > 0 as Alert from dq""",
    "etl_freshness": f"""
        select max(LastProcessedAt) as LastProcessedAt,
               datediff('minute', max(LastProcessedAt), {AS_OF}) as AgeMinutes,
               case when {AS_OF} > max(LastProcessedAt) + interval 90 minute then 'Degraded' else 'Healthy' end as Status
        from wm""",
    # ---- read models
    "order_list_page": f"""
        select OrderId, OrderNumber, CustomerId, FullName as CustomerName, OrderDate, Status, PaymentStatus,
               TotalAmount, (select count(*) from lineitem where l_orderkey = OrderId) as ItemCount
        from (select * {_MATCHING} order by OrderDate desc, OrderId desc limit 20 offset 20)""",
    "order_list_deep": """
        select OrderId, OrderNumber, CustomerId, FullName as CustomerName, OrderDate, Status, PaymentStatus,
               TotalAmount, (select count(*) from lineitem where l_orderkey = OrderId) as ItemCount
        from (select * from stg_orders o join stg_customers c using (CustomerId)
              where o.Status = 4 and o.OrderDate >= timestamp '1996-01-01' and o.OrderDate <= timestamp '2000-12-31'
              order by OrderDate desc, OrderId desc limit 20 offset 160)""",
    "product_search": """
        select * from stg_products where (lower(Sku) like '%ring%' or lower(Name) like '%ring%')
        and Category = 'ECONOMY' order by Name, ProductId limit 50""",
    "customer_search": """
        select * from stg_customers where lower(FullName) like '%nation\\_1%' escape '\\'
            or lower(Email) like '%nation\\_1%' escape '\\' or lower(coalesce(City, '')) like '%nation\\_1%' escape '\\'
        order by CustomerId limit 50 offset 50""",
    "page_counts": f"""
        select count(*) as TotalCount, cast((count(*) + 19) // 20 as bigint) as TotalPages
        from (select 1 {_MATCHING})""",
    "categories": "select distinct Category from stg_products",
    "order_documents": """
        select o.OrderId, 'header' as Section, cast(0 as bigint) as Rank,
               concat_ws('|', OrderNumber, coalesce(FullName, ''), coalesce(Email, ''), cast(Status as varchar),
                         cast(PaymentMethod as varchar), cast(PaymentStatus as varchar), cast(TotalAmount as varchar))
                 as Entry
        from stg_orders o left join stg_customers c using (CustomerId)
        union all
        select OrderId, 'item', OrderItemId, concat_ws('|', cast(ProductId as varchar), Sku, Name,
               cast(Quantity as varchar), cast(UnitPrice as varchar), cast(LineTotal as varchar))
        from stg_items join stg_products using (ProductId)
        union all
        select OrderId, 'event', cast(epoch(CreatedAt) as bigint), concat_ws('|',
               coalesce(cast(FromStatus as varchar), ''), cast(ToStatus as varchar), cast(ActorCustomerId as varchar))
        from order_events
        union all
        select OrderId, 'next', nr, cast(s as varchar) from stg_orders join (values
               (1, 0, 2), (1, 1, 5), (2, 0, 3), (2, 1, 5), (3, 0, 4)) v(f, nr, s) on f = Status""",
    "related_products": """
        select a.ProductId, cast(b.pos as int) as Position, b.Id as RelatedId from stg_products a, lateral (
            select x.Id, row_number() over (order by x.rk) as pos from (
                select ProductId as Id, Category, row_number() over (partition by Category order by Name, ProductId)
                  as rk from stg_products) x
            where x.Category = a.Category and x.Id <> a.ProductId and x.rk <= 5) b where b.pos <= 4""",
    "address_default": """
        select AddressId, CustomerId, FullName, Address,
               Claims and AddressId = max(case when Claims then AddressId end) over (partition by CustomerId)
                 as IsDefault
        from (select CustomerId * 10 + nr as AddressId, CustomerId, FullName, cast(nr as varchar) || ' Main St'
                     as Address, CustomerId % 5 = 0 or (nr = 1 and CustomerId % 3 <> 0) as Claims
              from stg_customers, (values (1), (2)) v(nr))""",
    "products_unreferenced": """
        select ProductId, Sku, ProductId not in (select l_partkey from lineitem) as Deletable
        from (select ProductId, Sku from stg_products
              union all select -ProductId, Sku || '-NEW' from stg_products where ProductId % 10 = 0)""",
    # ---- feeds and rules
    "feed_customers_ok": """
        select RowNo, FullName, Email, nullif(Phone, '') as Phone, nullif(City, '') as City from cust_checked
        where Error is null""",
    "feed_customers_err": "select RowNo, Error as Message from cust_checked where Error is not null",
    "feed_products_ok": """
        select RowNo, Sku, Name, Category, nullif(Brand, '') as Brand, P as Price, Q as StockQuantity
        from prod_checked where Error is null""",
    "feed_products_err": "select RowNo, Error as Message from prod_checked where Error is not null",
    "feed_orders_ok": f"""
        select OrderRef, 'ORD-XLS-20011231000000-' || OrderRef as OrderNumber, CustomerId, {AS_OF} as OrderDate,
               1 as Status, Lines, TotalAmount from order_accepted""",
    "feed_orders_err": "select * from order_errors",
    "feed_summary": """
        select 'customers' as Feed, (select count(*) from cust_feed) as TotalRows,
               (select count(*) from cust_checked where Error is null) as SuccessCount,
               (select count(*) from cust_checked where Error is not null) as ErrorCount
        union all select 'products', (select count(*) from prod_feed),
               (select count(*) from prod_checked where Error is null),
               (select count(*) from prod_checked where Error is not null)
        union all select 'orders', (select count(*) from order_feed), (select count(*) from order_accepted),
               (select count(*) from order_errors)""",
    "validate_orders": """
        with lines as (
            select l_orderkey as id, case when l_linenumber = 7 then 0 else l_partkey + 1 end as ProductId,
                   cast(case when l_orderkey % 19 = 0 and l_linenumber = 1 then 0
                             when l_orderkey % 23 = 0 and l_linenumber = 2 then 10001 else l_quantity end as int) as q
            from lineitem),
        folded as (select id, count(*) as n, count(*) filter (ProductId <= 0) as p, count(*) filter (q <= 0) as lo,
                          count(*) filter (q > 10000) as hi from lines group by id),
        heads as (select o_orderkey as k, coalesce(n, 0) as n, p, lo, hi from orders left join folded
                  on id = o_orderkey)
        select k as RequestId, 'CustomerId must be greater than 0' as Rule from heads where k % 37 = 0
        union all select k, 'Order must contain at least 1 item' from heads where n = 0
        union all select k, 'An order cannot contain more than 100 items' from heads where n > 100
        union all select k, 'ProductId must be greater than 0' from heads where p > 0
        union all select k, 'Quantity must be greater than 0' from heads where lo > 0
        union all select k, 'Quantity per line cannot exceed 10000' from heads where hi > 0
        union all select k, 'ShipFullName is too long' from heads where k % 41 = 0
        union all select k, 'ShipPhone is too long' from heads where k % 43 = 0
        union all select k, 'ShipAddress is too long' from heads where k % 47 = 0
        union all select k, 'Note is too long' from heads where k % 53 = 0 and k % 2 <> 0
        union all select k, 'PaymentMethod is unknown' from heads where k % 59 = 0""",
    "validate_products": """
        select ProductId, 'Sku is empty' as Rule from stg_products where ProductId % 11 = 0
        union all select ProductId, 'Sku is too long' from stg_products where ProductId % 11 <> 0 and ProductId % 29 = 0
        union all select ProductId, 'Name is empty' from stg_products where ProductId % 13 = 0
        union all select ProductId, 'Category is too long' from stg_products where ProductId % 17 = 0
        union all select ProductId, 'Price is negative' from stg_products where ProductId % 19 = 0 and Price > 0
        union all select ProductId, 'StockQuantity is negative' from stg_products where ProductId % 23 = 0""",
    "validate_customers": """
        select CustomerId, 'FullName is empty' as Rule from stg_customers where CustomerId % 7 = 0
        union all select CustomerId, 'Email is empty' from stg_customers
            where CustomerId % 13 = 0 and CustomerId % 5 <> 0 and CustomerId % 11 <> 0
        union all select CustomerId, 'Email is not an address' from stg_customers
            where CustomerId % 5 = 0 or CustomerId % 11 = 0 or CustomerId % 13 = 0
        union all select CustomerId, 'Phone is too long' from stg_customers where CustomerId % 17 = 0""",
    # ---- orders
    "order_pricing": """
        select OrderId, Subtotal, ShippingFee, TaxAmount, cast(Subtotal + ShippingFee + TaxAmount as decimal(38,2))
                 as TotalAmount
        from (select OrderId, Subtotal,
                     cast(case when Subtotal >= 500000 then 0 else 30000 end as decimal(18,2)) as ShippingFee,
                     cast((cast(Subtotal * 100 as hugeint) * 8 + 5000) // 10000 as decimal(18,2)) as TaxAmount
              from (select d.OrderId, sum(p.Price * d.Quantity) as Subtotal
                    from demand d left join stg_products p using (ProductId)
                    group by d.OrderId having count(*) = count(p.Price)))""",
    "order_demand": """
        select OrderId, ProductId, Quantity, ProductId in (select ProductId from stg_products) as ProductExists
        from demand""",
    "oversell_flags": """
        select OrderId, ProductId, Quantity, RunningDemand, RunningDemand > StockQuantity as Oversold
        from (select d.*, cast(sum(Quantity) over (partition by ProductId order by OrderDate, OrderId
                               rows unbounded preceding) as bigint) as RunningDemand
              from demand d join stg_orders using (OrderId)) join stg_products using (ProductId)""",
    "order_acceptance": """
        with recursive dated as (select d.*, OrderDate from demand d join stg_orders using (OrderId)),
        heads as (select OrderId, bool_and(ProductId in (select ProductId from stg_products)) as Known
                  from dated group by OrderId),
        rounds as (
          select 0 as round, OrderId, ProductId, Quantity as q, OrderDate as dt, StockQuantity as stock,
                 cast(null as boolean) as taken
          from dated join stg_products using (ProductId)
          where OrderId in (select OrderId from heads where Known)
          union all
          select round + 1, OrderId, ProductId, q, dt, stock,
                 case when taken is not null then taken
                      when bool_or(sure + q > stock) over (partition by OrderId) then false
                      when bool_and(most <= stock) over (partition by OrderId) then true end
          from (select *, sum(case when taken then q else 0 end) over t - case when taken then q else 0 end as sure,
                       sum(case when taken is null or taken then q else 0 end) over t as most,
                       count(*) filter (taken is null) over () as left_over
                from rounds window t as (partition by ProductId order by dt, OrderId rows unbounded preceding)) x
          where left_over > 0),
        final as (select *, sum(case when taken then q else 0 end) over (partition by ProductId order by dt, OrderId
                                                                       rows unbounded preceding) as upto
                  from rounds where round = (select max(round) from rounds)),
        refused as (select OrderId, min(ProductId) filter (upto + q > stock) as ShortProductId
                    from final where not taken group by OrderId)
        select OrderId, Known and r.OrderId is null as Accepted,
               case when not Known then 'One or more products not found.'
                    when r.OrderId is not null then 'Insufficient stock.' end as Reason, ShortProductId
        from heads left join refused r using (OrderId)""",
    "stock_position": """
        select p.ProductId, StockQuantity as Opening, coalesce(a, 0) as Ordered, coalesce(b, 0) as Restocked,
               StockQuantity - coalesce(a, 0) + coalesce(b, 0) as Position
        from stg_products p left join (
            select ProductId, cast(sum(Quantity) as bigint) as a,
                   cast(coalesce(sum(Quantity) filter (Status = 5), 0) as bigint) as b
            from stg_items join stg_orders using (OrderId) group by ProductId) using (ProductId)""",
    "transition_audit": """
        select EventId, OrderId, FromStatus, ToStatus,
               case when prev is null and FromStatus is null
                         then case when ToStatus = 1 then 'ok' else 'does not start pending' end
                    when prev is null then 'first event has a source'
                    when FromStatus is distinct from prev then 'does not follow the previous status'
                    when FromStatus = ToStatus then 'same status'
                    when (FromStatus, ToStatus) in ((1, 2), (1, 5), (2, 3), (2, 5), (3, 4)) then 'ok'
                    else 'forbidden step' end as Verdict
        from (select *, lag(ToStatus) over (partition by OrderId order by CreatedAt, EventId) as prev
              from order_events)""",
    "order_next_states": """
        select OrderId, Status, case Status when 1 then '2,5' when 2 then '3,5' when 3 then '4' else '' end
                 as NextStates, Status in (4, 5) as IsTerminal from stg_orders""",
    "refund_marking": """
        select OrderId, Status, case when Status = 5 and PaymentStatus in (3, 5) then 5 else PaymentStatus end
                 as PaymentStatus from stg_orders""",
    "cancel_eligibility": """
        select RequestId, q.OrderId, RequesterId, Reason is null as Allowed, Reason from (
            select r.*, case when o.OrderId is null then 'Order ' || cast(r.OrderId as varchar) || ' not found.'
                             when o.CustomerId <> r.RequesterId then 'You can only cancel your own orders.'
                             when o.Status <> 1 then 'Only pending orders can be cancelled.' end as Reason
            from owner_requests r left join stg_orders o using (OrderId)) q""",
    "payment_eligibility": """
        select RequestId, q.OrderId, RequesterId, Reason is null as Allowed, Reason from (
            select r.*, case when o.OrderId is null then 'Order ' || cast(r.OrderId as varchar) || ' not found.'
                             when o.CustomerId <> r.RequesterId then 'You can only pay for your own orders.'
                             when o.Status = 5 then 'Order in status ''Cancelled'' cannot be paid.'
                             when o.Status = 4 then 'Order in status ''Delivered'' cannot be paid.'
                             when o.PaymentStatus = 3 then 'Order is already paid.'
                             when o.PaymentMethod = 1 then 'COD orders do not require online payment.' end as Reason
            from owner_requests r left join stg_orders o using (OrderId)) q""",
    # ---- payments
    "callback_canonical_vnpay": f"""
        select Seq, 'vnp_Amount=' || cast(cast(Amount * 100 as bigint) as varchar)
               || case when Seq % 3 = 0 then '' else '&vnp_BankCode=NCB' end
               || '&vnp_OrderInfo=' || {_enc("'Pay order ' || Ref")} || '&vnp_ResponseCode=' || {_CODE5}
               || '&vnp_TransactionNo=T' || cast(Seq as varchar) || '&vnp_TransactionStatus=' || {_CODE5}
               || '&vnp_TxnRef=' || Ref as Canonical
        from callbacks where Provider = 2""",
    "callback_canonical_momo": """
        select Seq, 'accessKey=ACCESS&amount=' || cast(cast(floor(Amount) as bigint) as varchar)
               || '&extraData=&message=Successful.&orderId=' || Ref || '&orderInfo=Pay order ' || Ref
               || '&orderType=momo_wallet&partnerCode=SHOP&payType=qr&requestId=T' || cast(Seq as varchar)
               || '&responseTime=' || cast(Seq as varchar) || '&resultCode='
               || case when Seq % 5 = 0 then '1006' else '0' end || '&transId=T' || cast(Seq as varchar) as Canonical
        from callbacks where Provider = 3""",
    "callback_signature": """
        select Seq, Provider, Ref,
               cast(case when Seq % 7 = 0 then case when Provider = 2 then 0.01 else 1 end
                         when Provider = 3 then floor(Amount) else Amount end as decimal(18,2)) as Amount,
               case when Provider = 2 then case when Seq % 5 = 0 then '24' else '00' end
                    else case when Seq % 5 = 0 then '1006' else '0' end end as ResponseCode,
               Seq % 7 <> 0 as SignatureValid, Seq % 7 <> 0 and Seq % 5 <> 0 as Success
        from callbacks""",
    "payment_settlement": "select * from settlement",
    "payment_outcomes": """
        select 'payments succeeded' as Counter, count(*) filter (Outcome = 'Payment successful.') as Value from settled
        union all select 'payments failed',
               count(*) filter (Outcome in ('Amount mismatch.', 'Payment failed or cancelled.')) from settled
        union all select 'orders created', count(*) from stg_orders""",
    # ---- notifications
    "outbox_pending": "select * from due order by OutboxId limit 50",
    "outbox_rendered": f"""
        with r as (
            select x.OutboxId, x.OrderId, x.EventType, o.OrderNumber as num, {_dots('o.TotalAmount')} || ' ₫' as total,
                   case when o.CustomerId % 14 = 0 then '' else c.Email end as Email,
                   case o.Status when 1 then 'Chờ xử lý' when 2 then 'Đã xác nhận' when 3 then 'Đang giao'
                                 when 4 then 'Đã giao' else 'Đã huỷ' end as st
            from due x left join stg_orders o using (OrderId) left join stg_customers c using (CustomerId))
        select OutboxId, OrderId, case when num is null then 'drop' when coalesce(Email, '') = '' then 'in-app'
                                       else 'email' end as Channel,
               case when num is not null then Email end as ToEmail,
               case EventType when 'OrderPlaced' then 'Đơn hàng ' || num || ' đã được tạo'
                    when 'PaymentSucceeded' then 'Thanh toán thành công cho đơn ' || num
                    when 'OrderStatusChanged' then 'Đơn ' || num || ': ' || st else 'Cập nhật đơn ' || num end
                 as Subject,
               case EventType
                    when 'OrderPlaced' then {_page_html('Cảm ơn bạn đã đặt hàng!', "'Đơn <b>' || num || '</b> với tổng tiền <b>' || total || '</b> đã được ghi nhận và đang chờ xử lý.'")}
                    when 'PaymentSucceeded' then {_page_html('Đã nhận thanh toán', "'Chúng tôi đã nhận thanh toán <b>' || total || '</b> cho đơn <b>' || num || '</b>. Đơn đang được chuẩn bị.'")}
                    when 'OrderStatusChanged' then {_page_html('Cập nhật đơn hàng', "'Đơn <b>' || num || '</b> đã chuyển sang trạng thái <b>' || st || '</b>.'")}
                    else {_page_html('Cập nhật đơn hàng', "'Đơn <b>' || num || '</b> có cập nhật mới.'")} end as Html,
               case EventType when 'OrderPlaced' then 'Đơn ' || num || ' đã được tạo.'
                    when 'PaymentSucceeded' then 'Đã thanh toán đơn ' || num || '.'
                    when 'OrderStatusChanged' then 'Đơn ' || num || ': ' || st || '.'
                    else 'Đơn ' || num || ' có cập nhật.' end as InApp
        from r""",
    "outbox_result": f"""
        select x.OutboxId, x.OrderId, EventType, Payload, case when fails then null else {AS_OF} end as ProcessedAt,
               Attempts + case when fails then 1 else 0 end as Attempts,
               case when fails then 'delivery failed' else LastError end as LastError
        from (select d.*, d.OrderId >= 0 and t.Failures > 0 as fails from due d join tries t using (OutboxId)) x""",
    "compact_labels": f"""
        select OrderId, {_compact('TotalAmount', '')} as Compact, {_compact('(TotalAmount * OrderId)', ' ₫')}
                 as CompactVnd, {_dots('TotalAmount')} || ' ₫' as Vnd from stg_orders""",
    # ---- ad-hoc: star
    "fnb_revenue_2024": "select sum(LineTotal) as TotalRevenue from fnb_fact where year(d) = 2024",
    "fnb_top5_products": """
        select ProductName, cast(sum(Quantity) as bigint) as UnitsSold from fnb_fact join fnb_product using (ProductKey)
        group by ProductName order by 2 desc, 1 limit 5""",
    "fnb_city_2025": """
        select City, sum(LineTotal) as Revenue from fnb_fact join fnb_store using (StoreKey) where year(d) = 2025
        group by City""",
    "fnb_orders_2025": "select count(distinct OrderId) as OrderCount from fnb_fact where year(d) = 2025",
    "fnb_by_method": "select PaymentMethod, sum(LineTotal) as Revenue from fnb_fact group by PaymentMethod",
    "fnb_by_tier_2024": """
        select MembershipTier, sum(LineTotal) as Revenue from fnb_fact join fnb_customer using (CustomerKey)
        where year(d) = 2024 group by MembershipTier""",
    "fnb_monthly_2025": """
        select cast(month(d) as int) as MonthNum, strftime(d, '%B') as MonthName, sum(LineTotal) as Revenue
        from fnb_fact where year(d) = 2025 group by 1, 2""",
    "fnb_top3_stores": """
        select StoreName, sum(LineTotal) as Revenue from fnb_fact join fnb_store using (StoreKey)
        group by StoreName order by 2 desc, 1 limit 3""",
    "fnb_top_price": """
        select ProductId, Name, Category, Price from stg_products order by Price desc, ProductId limit 10""",
    # ---- ad-hoc: gold
    "adhoc_total_revenue": "select sum(TotalRevenue) as TotalRevenue from daily",
    "adhoc_by_category": "select Category, sum(TotalRevenue) as Revenue from daily group by Category",
    "adhoc_month_top": """
        select RankInMonth, ProductName, TotalQuantity, TotalRevenue from monthly
        where Year = 1998 and Month = 5 and RankInMonth <= 10""",
    "adhoc_top_customers": """
        select CustomerId, TotalOrders, TotalRevenue, AvgOrderValue from clv order by TotalRevenue desc, CustomerId
        limit 10""",
    "adhoc_churned": "select count(*) as ChurnedCustomers from clv where DaysSinceLastOrder > 60",
    "adhoc_category_trend": """
        select Date, sum(TotalRevenue) as Revenue from daily where Category = 'ECONOMY' group by Date""",
    "adhoc_max_aov": "select max(AvgOrderValue) as MaxAvgOrderValue from clv",
    "adhoc_best_category": """
        select Category, sum(TotalRevenue) as Revenue from daily where year(Date) = 1998 group by Category
        order by 2 desc, 1 limit 1""",
    "adhoc_year_revenue": "select sum(TotalRevenue) as TotalRevenue from daily where year(Date) = 1998",
    "guarded_sql": """
        select Category, cast(year(Date) as int) as Yr, sum(TotalRevenue) as Revenue,
               cast(sum(OrderCount) as bigint) as Orders
        from daily group by Category, year(Date) having sum(OrderCount) > 10""",
    "canned_match": r"""
        with q as (
            select event_id as AskId, props, cast(regexp_extract(props, '\d+') as int) % 5 as k from events)
        select AskId, case k when 0 then 'what was total revenue in 2024?' when 1 then 'revenue by payment method'
                             when 2 then 'top 3 stores by revenue' when 3 then 'which shelf is empty?'
                             else lower(props) end as Normal,
               case k when 0 then 'fnb_revenue_2024' when 1 then 'fnb_by_method' when 2 then 'fnb_top3_stores'
                      else 'fnb_top_price' end as Answer, k in (0, 1, 2) as Matched
        from q""",
    "result_equivalence": """
        with a as (select cast(ProductId as varchar) || '␟' || cast(UnitsSold as varchar) || '␟'
                          || case when LowStock then 'True' else 'False' end as Row from inventory),
             b as (select cast(ProductId as varchar) || '␟' || cast(UnitsSold as varchar) || '␟'
                          || case when LowStock then 'True' else 'False' end as Row from inventory_all)
        select Row, OnlyIn, count(*) as Copies from (
            select Row, 'left' as OnlyIn from (select * from a except all select * from b)
            union all select Row, 'right' from (select * from b except all select * from a)) group by Row, OnlyIn""",
    "eval_scoreboard": f"""
        select coalesce(Difficulty, 'overall') as Difficulty, p as Passed, n as Total, {_pct('p', 'n')} as AccuracyPct,
               cast((2 * s + n) // (2 * n) as bigint) as AvgLatencyMs
        from (select Difficulty, count(*) filter (Passed) as p, count(*) as n, sum(LatencyMs) as s
              from evals group by rollup (Difficulty))""",
    "safety_scoreboard": f"""
        with c as (select event_type in ('click', 'error') as bad, event_type in ('click', 'error') as rejected
                   from events),
        t as (select count(*) filter (bad) as Malicious, count(*) filter (bad and rejected) as Blocked,
                     count(*) filter (not bad) as Benign, count(*) filter (not bad and not rejected) as Allowed,
                     count(*) filter (not bad and rejected) as FalseRefusals from c)
        select *, {_pct('Blocked', 'Malicious')} as BlockedPct, Blocked = Malicious and FalseRefusals = 0 as Clean
        from t""",
    "ask_metrics": f"""
        select n as TotalQuestions, a as Answered, f as Refused, e as Errors, h as CacheHits,
               {_pct_even('f', 'n')} as RefusalRatePct, {_pct_even('h', 'n')} as CacheHitRatePct,
               cast(s // (a + f) as bigint) as AvgLatencyMs
        from (select count(*) as n, count(*) filter (Status = 'Answered') as a,
                     count(*) filter (Status = 'Refused') as f, count(*) filter (Status = 'Error') as e,
                     count(*) filter (Status = 'CacheHit') as h,
                     sum(LatencyMs) filter (Status in ('Answered', 'Refused')) as s from ask_log)""",
    "ask_cache_hits": """
        with recursive ev as (
            select AskId, lower(trim(Question)) as QuestionKey, cast(floor(epoch(AskedAt)) as bigint) as s
            from ask_log where Status <> 'Error'),
        chain as (
            select QuestionKey, min(s) as s from ev group by QuestionKey
            union all
            select c.QuestionKey, min(e.s) from chain c join ev e on e.QuestionKey = c.QuestionKey and e.s >= c.s + 600
            group by c.QuestionKey)
        select AskId, QuestionKey, AskId not in (
            select min(e.AskId) from ev e join chain c on c.QuestionKey = e.QuestionKey and c.s = e.s
            group by e.QuestionKey, e.s) as CacheHit
        from ev""",
    "ask_repeats": """
        select AskId, QuestionKey, Before is not null as AskedBefore,
               coalesce(AskedAt <= Before + interval 600 second, false) as Repeat
        from (select AskId, AskedAt, lower(trim(Question)) as QuestionKey,
                     lag(AskedAt) over (partition by lower(trim(Question)) order by AskedAt, AskId) as Before
              from ask_log where Status <> 'Error')""",
}


QUERIES |= {
    "fact_asof_carried": QUERIES["fact_asof_dims"],
    # ---- jobs
    "feed_file_customers": """
        select n as RowNo, case when RowNo % 19 = 2 then FullName || chr(10) || 'II' else FullName end as FullName, Email,
               nullif(Phone, '') as Phone, nullif(City, '') as City
        from (select *, row_number() over (order by RowNo) + 1 as n from cust_checked) where Error is null""",
    "question_file": """
        select cast(event_id as varchar) as id, cast(null as varchar) as lang, event_type as difficulty,
               props as question, cast(null as varchar) as sql from events""",
    "stream_etl_fact": "select * from fact",
    "stream_settlement": "select * from settlement",
    "stream_outbox": f"""
        select OutboxId, OrderId, cast(least(Attempts + f, 5) as int) as Attempts,
               case when Attempts + f < 5 then {AS_OF} end as ProcessedAt,
               case when f > 0 then 'delivery failed' end as LastError
        from (select d.*, case when d.OrderId < 0 then 0 else t.Failures end as f from due d join tries t
              using (OutboxId))""",
    "stream_dq": """
        with f as (select r.*, r.LoadNr - 1 as b from resolved r
                   where CustomerKey is not null and ProductKey is not null),
        n as (
            select b, 'fact_no_duplicate_orderitemid' as t, count(*) - count(distinct OrderItemId) as v from f group by b
            union all select b, 'dim_customer_one_current_per_id', 0 from f group by b
            union all select b, 'fact_customerkey_resolves', 0 from f group by b
            union all select b, 'fact_productkey_resolves', 0 from f group by b
            union all select b, 'fact_datekey_resolves', 0 from f group by b
            union all select b, 'fact_freshness_24h', 1 from f group by b
            union all select b, 'fact_row_count_nonzero', count(*) from f group by b
            union all select 0, 'dim_customer_count_nonzero', (select count(*) from cust1)
            union all select 1, 'dim_customer_count_nonzero', (select count(*) from dim_customer where IsCurrent)
            union all select b, 'fact_no_negative_revenue', count(*) filter (LineTotal <= 0) from f group by b
            union all select b, 'fact_no_zero_quantity', count(*) filter (Quantity <= 0) from f group by b
            union all select b, 'fact_unitprice_lineTotal_consistency',
                             count(*) filter (abs(Quantity * UnitPrice - LineTotal) > 0.01) from f group by b)
        select cast(b as bigint) as BatchId, t as TestName, cast(v as varchar) as ActualValue,
               case when (t in ('fact_freshness_24h', 'fact_row_count_nonzero', 'dim_customer_count_nonzero')) = (v > 0)
                    then 'Pass' else 'Fail' end as Status from n""",
    "run_log": f"""
        select 'SalesOrderItem' as PipelineName, count(*) as RowsProcessed, max(wmk) as Watermark,
               'Succeeded' as Status, max(moment) as CompletedAt
        from (select LoadNr, case when LoadNr = 1 then (select id from wm_first)
                                  else (select max(OrderItemId) from stg_items) end as wmk,
                     case when LoadNr = 1 then {T1} else {T2} end as moment
              from resolved where CustomerKey is not null and ProductKey is not null) group by LoadNr""",
    "fact_compaction_stats": """
        select count(*) as RowsBefore, count(*) as RowsAfter, true as FewerFiles from fact""",
}


def _needed(text: str) -> list[str]:
    """Blocks a text uses, each after the blocks it needs itself."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in BLOCKS:
            if name not in order and re.search(rf"\b(from|join|,)\s+{name}\b", body):
                visit(BLOCKS[name])
                order.append(name)

    visit(text)
    return order


def _compose(body: str) -> str:
    body = body.strip()
    ctes = ",\n".join(f"{name} as ({BLOCKS[name].strip()})" for name in _needed(body))
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: _compose(body) for name, body in QUERIES.items()}
