"""A small flights file with every special case; only its first ten data rows are good."""

HAND_CSV = """\
month,op_unique_carrier,origin,dest,dep_delay,arr_delay,cancelled
1,AA,JFK,LAX,10,5,0
1,AA,JFK,LAX,10,5,0
2,AA,JFK,LAX,-4,-10,0.0
10,AA,JFK,LAX,,,1
3,BB,JFK,LAX,6,,0
3,BB,JFK,LAX,20,,1
4,BB,JFK,SFO,None,None,0
5,CC,JFK,SFO,,,1
5,DD,BOS,JFK,7,1,0
6,"EE, Inc",BOS,JFK,7,2,0
month,op_unique_carrier,origin,dest,dep_delay,arr_delay,cancelled

x,DD,BOS,JFK,3,3,0
6,  ,BOS,JFK,3,3,0
"""
